"""What a run depends on besides its tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import UTC, datetime, timedelta

# The words written to the datasets.
DEVICE_ACTIVE = "ativa"
DEVICE_INACTIVE = "inativa"
LINKED = "com_vinculo"
UNLINKED = "sem_vinculo"
LINK_ACTIVE = "ativo"
LINK_INACTIVE = "inativo"
PARITY_STEPS = {0: "Novilha", 1: "Primipara"}
PARITY_DEFAULT = "Multípara"


@dataclass(frozen=True)
class Words:
    device_active: str = DEVICE_ACTIVE
    device_inactive: str = DEVICE_INACTIVE
    linked: str = LINKED
    unlinked: str = UNLINKED
    link_active: str = LINK_ACTIVE
    link_inactive: str = LINK_INACTIVE
    parity_steps: Mapping[int, str] = field(default_factory=lambda: dict(PARITY_STEPS))
    parity_default: str = PARITY_DEFAULT
    # None labels a missing count of deliveries like the default.
    parity_null: str | None = None


def naive_utc(moment: datetime) -> datetime:
    return moment.astimezone(UTC).replace(tzinfo=None) if moment.tzinfo else moment


@dataclass(frozen=True)
class Params:
    """`as_of` and `since` are UTC unless they carry another zone. `context_type` limits accesses
    to one kind of context; by default the kind is not looked at."""

    as_of: datetime
    since: datetime = datetime(2025, 1, 1)
    window: timedelta = timedelta(hours=48)
    shift_hours: int = 3
    context_type: str | None = None
    words: Words = field(default_factory=Words)

    def __post_init__(self) -> None:
        for name in ("as_of", "since"):
            object.__setattr__(self, name, naive_utc(getattr(self, name)))

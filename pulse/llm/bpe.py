"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece's bytes the table keeps the one token that can stand last in the
prefix's encoding: a token that ends there and forms a valid pair with the last token of the prefix
before it. Two tokens form a valid pair if merging their joined bytes gives just them. Following the
last tokens back from the end gives the encoding. As the entry of a prefix does not depend on what
follows, bytes can be appended, or replaced from any place on, by computing the entries after it.

New pieces of ordinary length are sorted and get their tables together, a prefix length at a time:
prefixes that neighbours share are computed once, and numpy takes the same step for all the others.

Texts are cut into pieces by the tokenizer's pattern. A piece that is a token itself is that token.
Python's own engine cuts texts of the basic plane, as it is faster than `regex`: the classes that only
`regex` knows are spelled out for it.

Defined results: a null text counts as empty and gives no ids; text that names special tokens is
ordinary text; repeated rows are encoded each by itself; other columns pass through untouched.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable
from functools import lru_cache
from itertools import islice
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.llm.common import in_parts, text_or_empty

PIECES_AT_ONCE = 1 << 16
GROUP_CHARS = 1 << 20
CACHED_PIECES = 600_000
CACHED_CHARS = 1 << 23
CACHED_PAIRS = 400_000
TABLES_AT_ONCE = 1 << 14
TABLE_BYTES = 64
PAIR_SLOT_BITS = 21
UNRANKED = 1 << 40
BASIC_PLANE = "".join(map(chr, range(1 << 16)))
BEYOND = re.compile(r"[^\u0000-\uffff]")
# Classes that Python's own engine lacks or reads in another way, and the parts of a pattern that,
# but for these classes, both engines read alike.
CLASS = r"\\p\{\w+\}|\\s"
PART = rf"\[\^?(?:{CLASS}|[^\\\[\]^&|~-])+\]|{CLASS}|\\S|\(\?[:=!]|[^\\\[\]^$.({{}}]"


class Vocabulary:
    """Ranks of byte strings, and the merge rule that they imply."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.by_rank = pa.array(map(self.tokens.get, range(max(self.tokens) + 1)), pa.large_binary())
        # Every ending of a token, with the token's rank where the ending is a token itself.
        self.endings = {
            token[i:]: ranks.get(token[i:], -1) for token in ranks for i in range(len(token))
        }
        self.pairs: dict[tuple[int, int], bool] = {}
        self.reached: dict[int, bool] = {}
        self.edges: dict[tuple[int, int], list[tuple[bytes, int, int]]] = {}

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        ranks = {}
        with open(path, "rb") as lines:
            for line in lines:
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
        return cls(ranks)

    def merge(self, data: bytes, down_to: int = 1) -> list[bytes]:
        """Join the neighbours of lowest rank, leftmost first, until none or few parts are left."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > down_to:
            best, at = min(
                (self.ranks.get(a + b, UNRANKED), i)
                for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))
            )
            if best == UNRANKED:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def reachable(self, rank: int) -> bool:
        """Whether merging a token's own bytes gives the token."""
        known = self.reached.get(rank)
        if known is None:
            known = self.reached[rank] = len(self.merge(self.tokens[rank])) == 1
        return known

    def edge(self, rank: int, side: int) -> list[tuple[bytes, int, int]]:
        """The parts that stand at one end of a token while its bytes merge into it.

        side is 0 for the first part, -1 for the last. Each part comes with the rank at which it
        appears and the rank at which it goes into a larger part."""
        known = self.edges.get((rank, side))
        if known is None:
            known, part, until = [], self.tokens[rank], UNRANKED
            while len(part) > 1:
                appears = self.ranks[part]
                known.append((part, appears, until))
                part, until = self.merge(part, down_to=2)[side], appears
            known.append((part, -1, until))
            self.edges[rank, side] = known
        return known

    def valid_pair(self, left: int, right: int) -> bool:
        """Whether merging the joined bytes of two tokens gives just those two.

        It does unless two parts that stand side by side at the seam for a while join before
        either of them goes into its own token. Of equal ranks the leftmost merges first."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= CACHED_PAIRS:
                self.pairs.clear()
            ranks = self.ranks
            known = self.reachable(right) and not any(
                from_a < until_b
                and from_b < until_a
                and (rank := ranks.get(a + b)) is not None
                and rank < until_a
                and rank <= until_b
                for a, from_a, until_a in self.edge(left, -1)
                for b, from_b, until_b in self.edge(right, 0)
            )
            self.pairs[left, right] = known
        return known

    def decode(self, packed: list[bytes]) -> list[bytes]:
        """The bytes that packed ids stand for."""
        sizes = np.array(list(map(len, packed)), np.int64)
        if (sizes % 4).any():
            raise ValueError("packed ids have four bytes each")
        ids = np.frombuffer(b"".join(packed), "<u4")
        if not len(ids):
            return [b""] * len(packed)
        found = self.by_rank.take(pa.array(ids))
        if found.null_count:
            raise KeyError("no token has this id")
        _, starts, data = found.buffers()
        stops = np.frombuffer(starts, np.int64)[np.cumsum(sizes // 4)].tolist()
        return [data[a:b].to_pybytes() for a, b in zip([0, *stops], stops, strict=False)]


class PrefixTable:
    """The last token of every prefix of some bytes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def append(self, more: bytes) -> None:
        """Add bytes at the end; the entries there are stay as they are."""
        words = self.vocabulary
        endings, pairs, valid_pair = words.endings, words.pairs, words.valid_pair
        data = self.data = self.data + more
        last = self.last
        for end in range(len(last) + 1, len(data) + 1):
            for start in range(end - 1, -1, -1):
                rank = endings.get(data[start:end])
                if rank is None:
                    start = -1
                    break
                if rank < 0:
                    continue
                if start == 0:
                    if words.reachable(rank):
                        break
                else:
                    known = pairs.get((last[start - 1], rank))
                    if known or known is None and valid_pair(last[start - 1], rank):
                        break
            else:
                start = -1
            if start < 0:
                raise ValueError(f"no token ends at byte {end}")
            last.append(rank)

    def replace(self, start: int, end: int, new: bytes) -> None:
        """Put `new` in the place of data[start:end], computing the entries from `start` on."""
        rest = new + self.data[end:]
        self.data = self.data[:start]
        del self.last[start:]
        self.append(rest)

    def encode(self) -> list[int]:
        ids, end = [], len(self.data)
        while end:
            ids.append(self.last[end - 1])
            end -= len(self.vocabulary.tokens[ids[-1]])
        return ids[::-1]


class PrefixTables:
    """The last token of every prefix of many short byte strings at once."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        # Every ending of a token is a node; a node's child is the ending with one byte before it.
        number = {ending: i for i, ending in enumerate(sorted(vocabulary.endings, key=len), 1)}
        number[b""] = 0
        self.ranks = np.full(len(number), -1, np.int64)
        links = np.empty(len(number) - 1, np.int64)
        for ending, i in number.items():
            if i:
                self.ranks[i] = vocabulary.endings[ending]
                links[i - 1] = number[ending[1:]] << 8 | ending[0]
        self.children = np.argsort(links) + 1
        self.links = links[self.children - 1]
        n_ranks = max(vocabulary.tokens) + 1
        self.n_ranks = n_ranks
        self.lengths = np.zeros(n_ranks, np.int64)
        for rank, token in vocabulary.tokens.items():
            self.lengths[rank] = len(token)
        # Answers met lately, by pair of tokens; a pair may take the slot of another.
        self.pair_keys = np.full(1 << PAIR_SLOT_BITS, -1, np.int64)
        self.pair_valid = np.zeros(1 << PAIR_SLOT_BITS, bool)

    def _valid(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * self.n_ranks + right
        slots = (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - PAIR_SLOT_BITS)
        valid, missed = self.pair_valid[slots], self.pair_keys[slots] != keys
        if missed.any():
            new, place = np.unique(keys[missed], return_inverse=True)
            pairs, valid_pair = self.vocabulary.pairs, self.vocabulary.valid_pair
            found = []
            for pair in map(divmod, new.tolist(), [self.n_ranks] * len(new)):
                known = pairs.get(pair)
                found.append(valid_pair(*pair) if known is None else known)
            valid[missed] = found = np.array(found, bool)[place]
            # Where two of these pairs want one slot, none gets it.
            self.pair_keys[slots[missed]] = keys[missed]
            self.pair_valid[slots[missed]] = found
            lost = self.pair_keys[slots[missed]] != keys[missed]
            self.pair_keys[slots[missed][lost]] = -1
        return valid

    def last_tokens(self, data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """By prefix length and string, for sorted strings of these lengths in the rows of `data`."""
        n, width = data.shape
        unlike = np.ones((n, width + 1), bool)
        unlike[1:, :width] = data[1:] != data[:-1]
        shared = unlike.argmax(1)
        shared[1:] = np.minimum(shared[1:], np.minimum(lengths[1:], lengths[:-1]))
        last, rows = np.zeros((width + 1, n), np.int64), np.arange(n)
        for end in range(1, width + 1):
            own = (lengths >= end) & (shared < end)
            here, node = np.flatnonzero(own), np.zeros(own.sum(), np.int64)
            for start in range(end - 1, -1, -1):
                link = node << 8 | data[here, start]
                at = np.minimum(np.searchsorted(self.links, link), len(self.links) - 1)
                if (self.links[at] != link).any():
                    raise ValueError(f"no token ends at byte {end}")
                node = self.children[at]
                rank = self.ranks[node]
                token = np.flatnonzero(rank >= 0)
                right = rank[token]
                if start:
                    fits = self._valid(last[start, here[token]], right)
                else:
                    fits = np.array([self.vocabulary.reachable(x) for x in right.tolist()], bool)
                done = token[fits]
                last[end, here[done]] = rank[done]
                more = np.ones(len(here), bool)
                more[done] = False
                here, node = here[more], node[more]
                if not len(here):
                    break
            if len(here):
                raise ValueError(f"no token ends at byte {end}")
            # A shared prefix has the entry of the row that it was computed for.
            last[end] = last[end, np.maximum.accumulate(np.where(own, rows, 0))]
        return last

    def encode(self, strings: list[bytes]) -> list[bytes]:
        """Packed ids of sorted strings, none of them empty."""
        lengths = np.array(list(map(len, strings)))
        width = int(lengths.max())
        flat = b"".join(string.ljust(width, b"\0") for string in strings)
        data = np.frombuffer(flat, np.uint8).reshape(-1, width)
        last = self.last_tokens(data, lengths)
        steps, rows, ends = [], np.arange(len(strings)), lengths
        while len(rows):
            ids = last[ends, rows]
            steps.append((rows, ids))
            ends = ends - self.lengths[ids]
            rows, ends = rows[ends > 0], ends[ends > 0]
        counts = np.zeros(len(strings), np.int64)
        for rows, _ in steps:
            counts[rows] += 1
        stops = np.cumsum(counts)
        packed = np.empty(stops[-1], "<u4")
        for step, (rows, ids) in enumerate(steps, 1):
            packed[stops[rows] - step] = ids
        whole, bounds = packed.tobytes(), (stops * 4).tolist()
        return [whole[a:b] for a, b in zip([0, *bounds], bounds, strict=False)]


class Kept(dict):
    """Packed ids by piece. A piece that it lacks gives None, and is noted."""

    def __init__(self):
        self.lacked: list[str] = []

    def __missing__(self, piece: str) -> None:
        self.lacked.append(piece)


class PieceIds:
    """Packed ids of the pieces met lately, in two generations.

    When the young generation is full, by pieces or by their characters, it becomes the old one, and
    the old one is dropped; pieces that come again move back, so that common pieces are never encoded
    twice."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.tables = PrefixTables(vocabulary)
        self.known, self.old = Kept(), Kept()
        self.chars = 0

    def pack(self, lines: Iterable[list[str]]) -> list[bytes]:
        """The packed ids of each list of pieces."""
        known = self.known
        found = [list(map(known.__getitem__, pieces)) for pieces in lines]
        lacked, known.lacked = known.lacked, []
        if lacked:
            self.learn(set(lacked))
            ids = map(self.known.__getitem__, lacked)
            found = [[x or next(ids) for x in line] for line in found]
        return list(map(b"".join, found))

    def learn(self, missing: set[str]) -> None:
        """Encode new pieces in order: together, or if long each by editing the table of the one
        before it."""
        if len(self.known) >= CACHED_PIECES or self.chars >= CACHED_CHARS:
            self.old, self.known, self.chars = self.known, Kept(), 0
        self.chars += sum(map(len, missing))
        known, old, ranks = self.known, self.old, self.vocabulary.ranks
        # Not missing.intersection(old), which goes through all that is kept.
        again = set(filter(old.__contains__, missing))
        known.update(zip(again, map(old.__getitem__, again), strict=True))
        table = PrefixTable(self.vocabulary)
        short: list[str] = []
        strings: list[bytes] = []
        # Sorted by code points is sorted by bytes.
        for piece in sorted(missing.difference(again)):
            data = piece.encode()
            rank = ranks.get(data)
            if rank is not None:
                known[piece] = rank.to_bytes(4, "little")
            elif len(data) <= TABLE_BYTES:
                short.append(piece)
                strings.append(data)
            else:
                shared = len(commonprefix((table.data, data)))
                table.replace(shared, len(table.data), data[shared:])
                known[piece] = np.array(table.encode(), "<u4").tobytes()
        for start in range(0, len(short), TABLES_AT_ONCE):
            part = slice(start, start + TABLES_AT_ONCE)
            known.update(zip(short[part], self.tables.encode(strings[part]), strict=True))


def members(name: str) -> str:
    """The basic plane's members of a class of `regex`, as ranges."""
    runs = regex.findall(f"(?:{name})+", BASIC_PLANE)
    return "".join(f"\\u{ord(run[0]):04x}-\\u{ord(run[-1]):04x}" for run in runs)


def spelled_out(pattern: str) -> str | None:
    """The pattern for Python's own engine, over texts of the basic plane; None if the engines could
    read its parts differently."""
    ranges = {name: members(name) for name in (r"\s", *re.findall(CLASS, pattern))}
    if not re.fullmatch(f"(?:{PART})*", pattern) or not all(ranges.values()):
        return None

    def spelled(part: re.Match) -> str:
        if part[0] == r"\S":
            return f"[^{ranges[r'\s']}]"
        if part[0] in ranges:
            return f"[{ranges[part[0]]}]"
        return re.sub(CLASS, lambda name: ranges[name[0]], part[0])

    return re.sub(PART, spelled, pattern)


class Cutter:
    """Cuts texts into the matches of a pattern."""

    def __init__(self, pattern: str):
        self.full = regex.compile(pattern)
        plain = spelled_out(pattern)
        self.plain = self.full if plain is None else re.compile(plain)

    def _engine(self, text: str):
        return self.plain if text.isascii() or not BEYOND.search(text) else self.full

    def findall(self, text: str) -> list[str]:
        return self._engine(text).findall(text)

    def finditer(self, text: str):
        return self._engine(text).finditer(text)


@lru_cache(maxsize=2)
def tools(path: str, pattern: str):
    vocabulary = Vocabulary.load(path)
    return vocabulary, PieceIds(vocabulary), Cutter(pattern)


def packed_ids(texts: list[str], known: PieceIds, pattern) -> list[bytes]:
    """Every text's ids as little-endian unsigned 32-bit integers."""
    packed = []
    for group in groups_of(texts):
        if len(group) == 1 and len(group[0]) > GROUP_CHARS:
            packed.append(b"".join(long_ids(group[0], known, pattern)))
            continue
        packed.extend(known.pack(map(pattern.findall, group)))
    return packed


def groups_of(texts: list[str]):
    """Runs of texts of at most GROUP_CHARS together, or one longer text."""
    group, chars = [], 0
    for text in texts:
        if group and chars + len(text) > GROUP_CHARS:
            yield group
            group, chars = [], 0
        group.append(text)
        chars += len(text)
    if group:
        yield group


def long_ids(text: str, known: PieceIds, pattern):
    found = (match.group() for match in pattern.finditer(text))
    while pieces := list(islice(found, PIECES_AT_ONCE)):
        yield from known.pack([pieces])


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", name: str = "ids") -> DataFrame:
    """Adds the ids of every text, packed as little-endian unsigned 32-bit integers.

    `path` is read in every task and must be the same file on every machine."""
    @F.arrow_udf("binary")
    def ids(texts: pa.Array) -> pa.Array:
        _, known, compiled = tools(path, pattern)
        packed = [ids for part in in_parts(texts) for ids in packed_ids(part, known, compiled)]
        return pa.array(packed, pa.binary())

    return docs.withColumn(name, ids(text_or_empty(text)))


def decode(docs: DataFrame, path: str, pattern: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Adds the bytes that packed ids stand for."""
    @F.arrow_udf("binary")
    def decoded(packed: pa.Array) -> pa.Array:
        vocabulary, texts = tools(path, pattern)[0], []
        for part in in_parts(packed):
            found = iter(vocabulary.decode([value for value in part if value is not None]))
            texts.extend(None if value is None else next(found) for value in part)
        return pa.array(texts, pa.binary())

    return docs.withColumn(name, decoded(F.col(ids)))


def n_tokens(ids: Column) -> Column:
    return (F.length(ids) / 4).cast("bigint")

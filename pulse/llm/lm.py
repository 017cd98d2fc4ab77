"""Class-based bigram language model: exchange clustering, transitions, emissions.

Tokens are the words of a text, lower-cased in A-Z, then one end token. Word counts come from all
training documents. Classes are learned in two steps, both on counts over all training bigrams.

First the most frequent words form a unit each, all other words units by their last letters; the end
is a unit too. Exchange clustering moves units between classes: it starts from classes dealt by
frequency, and in each round counts how often every unit stands before and after every class, then
moves half of the units, one after the other, each to the class that most raises the likelihood of the
class bigrams. Then every other word of the lookup table is moved by the same measure: how often it
stands before and after every class is counted on Spark, and it joins the class where those neighbours
are likeliest. Words beyond the table, and unseen ones, have the class of their last letters: a
transition needs the classes of both its words in one task, and the table, whose size is bounded, is
what a task can hold. The table takes the most frequent words, of equally frequent ones some by a hash, so
it is full however flat the counts are.

A text's score is the sum over its tokens of log10 P(class | class before) + log10 P(word | class).
Transitions, counted in one more pass, are smoothed by `transition_mass` per class. An emission is
(c + 0.5) / (N + 0.5 (V + 1)) with the count of the word and the size and distinct words of its class,
so each class keeps mass for one unknown word, and both P sum to one.

Scoring looks the words of the table up in every task; the other words of a document go, counted, to
a join with all word counts, and come back summed by document. No word that is frequent enough to be
a hot key goes through that join. Words of more than MAX_WORD_BYTES are named by a digest, so that
none is too long to be held.

All statistics that reach the driver are bounded by units, classes and the size of the table.

Defined results: a null text counts as empty and consists of the end token; a null doc_id counts as
empty text when it is hashed to training or held-out; ids may be of any type; rows that repeat a
doc_id with its text score alike and all come back; without training documents every count is zero; no
rows give none; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.llm.common import PART_ROWS, in_parts, stored, text_or_empty

END = b"\n"
MAX_WORD_BYTES = 64
FLUSH_WORDS = 200_000
FLUSH_PAIRS = 4_000_000
HASH_BUCKETS = 4096


@dataclass(frozen=True)
class Settings:
    """Sizes of the model; all bound what tasks and the driver hold."""

    lookup_words: int = 200_000
    unit_words: int = 4096
    ending_units: int = 1024
    ending_bytes: int = 3
    classes: int = 64
    rounds: int = 4
    transition_mass: float = 0.5

    @property
    def units(self) -> int:
        return 1 + self.unit_words + self.ending_units

    def ending(self, word: bytes) -> int:
        return zlib.crc32(word[-self.ending_bytes :]) % self.ending_units


def short_name(word: bytes) -> bytes:
    """A long word by its digest; the first byte occurs in no text, the last ones are its own."""
    if len(word) <= MAX_WORD_BYTES:
        return word
    return b"\xff" + hashlib.sha256(word).digest() + word[-8:]


def tokens(text: str) -> list[bytes]:
    """The words of a text; long ones have their short names where words are counted or looked up."""
    return text.encode().lower().split()


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 1


class Codes(dict):
    """A number for every word: those given, and by its ending for any other, kept for a while."""

    def __init__(self, given: dict[bytes, int], by_ending: list[int], settings: Settings):
        super().__init__(given)
        self.given, self.by_ending, self.settings = given, by_ending, settings

    def __missing__(self, word: bytes) -> int:
        if len(word) > MAX_WORD_BYTES:
            return self[short_name(word)]
        if len(self) > len(self.given) + FLUSH_WORDS:
            self.clear()
            self.update(self.given)
        code = self[word] = self.by_ending[self.settings.ending(word)]
        return code

    def __reduce__(self):
        return Codes, (self.given, self.by_ending, self.settings)

    def line(self, words: list[bytes]) -> np.ndarray:
        """The numbers of a text's words between two of the end, which is number 0."""
        numbers = np.zeros(len(words) + 2, np.int64)
        numbers[1:-1] = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return numbers


def count_words(batches):
    counts: Counter = Counter()

    def flush():
        batch = pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
            ["word", "n"],
        )
        counts.clear()
        return batch

    for batch in batches:
        for part in in_parts(batch.column(0)):
            for text in part:
                words = tokens(text)
                if max(map(len, words), default=0) > MAX_WORD_BYTES:
                    words = map(short_name, words)
                counts.update(words)
                counts[END] += 1
                if len(counts) > FLUSH_WORDS:
                    yield flush()
    yield flush()


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over a column of texts; the end token is END."""
    partial = texts.mapInArrow(count_words, "word binary, n bigint")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


def counted_keys(texts: DataFrame, codes: Codes, keys_of, few: int | None = None) -> DataFrame:
    """(key, n): how often every key that `keys_of` makes of a text's line occurs, by task. With
    `few`, all keys are below that."""
    shared = texts.sparkSession.sparkContext.broadcast(codes)

    def count(batches):
        known = shared.value
        waiting: list[np.ndarray] = []
        size = 0

        def flush():
            if few:
                n = np.bincount(np.concatenate(waiting), minlength=few)
                keys = np.flatnonzero(n)
                n = n[keys]
            else:
                keys, n = np.unique(np.concatenate(waiting), return_counts=True)
            waiting.clear()
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n.astype(np.int64))], ["key", "n"])

        for batch in batches:
            for part in in_parts(batch.column(0)):
                for text in part:
                    keys = keys_of(known.line(tokens(text)))
                    waiting.append(keys)
                    size += len(keys)
                    if size > FLUSH_PAIRS:
                        yield flush()
                        size = 0
        if waiting:
            yield flush()

    return texts.mapInArrow(count, "key bigint, n bigint")


def summed(keys: DataFrame) -> DataFrame:
    return keys.groupBy("key").agg(F.sum("n").alias("n"))


def own_units(words: list[bytes], settings: Settings) -> Codes:
    """The unit of every word: its own, or that of its last letters."""
    own = {END: 0} | {word: i for i, word in enumerate(words[: settings.unit_words], 1)}
    first = 1 + settings.unit_words
    return Codes(own, [first + i for i in range(settings.ending_units)], settings)


def bigrams(texts: DataFrame, units: Codes) -> DataFrame:
    """(u, v, n): unit bigrams of all texts; a text starts and ends with the end unit."""
    base = units.settings.units

    def pairs(line: np.ndarray) -> np.ndarray:
        return line[:-1] * base + line[1:]

    return summed(counted_keys(texts, units, pairs)).select(
        F.floor(F.col("key") / base).cast("int").alias("u"), (F.col("key") % base).cast("int").alias("v"), "n"
    )


def beside_classes(pairs: DataFrame, classes: np.ndarray, n_classes: int) -> np.ndarray:
    """(2, units, classes): how often every unit stands before, and after, every class."""
    lookup = F.array(*(F.lit(int(c)) for c in classes))

    def side(unit: str, other: str, row: int) -> DataFrame:
        return pairs.groupBy(
            F.lit(row).alias("row"), F.col(unit).alias("unit"), F.get(lookup, F.col(other)).alias("class")
        ).agg(F.sum("n").alias("n"))

    table = side("u", "v", 0).union(side("v", "u", 1)).toArrow()
    counts = np.zeros((2, len(classes), n_classes))
    row, unit, cls, n = (table.column(i).to_numpy() for i in range(4))
    counts[row, unit, cls] = n
    return counts


def xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def exchange(
    classes: np.ndarray, beside: np.ndarray, alone: np.ndarray, movable: np.ndarray, n_classes: int
) -> np.ndarray:
    """Move units, most frequent first, each to the class where the likelihood is highest.

    alone[u] is how often u follows itself. Class bigrams are kept up to date with every move;
    the units' own neighbour classes are those at the start of the round."""
    classes = classes.copy()
    after, before = beside
    table = np.zeros((n_classes, n_classes))
    np.add.at(table, classes, after)
    for unit in movable:
        old = classes[unit]
        follow, lead, own = after[unit].copy(), before[unit].copy(), alone[unit]
        follow[old] -= own
        lead[old] -= own
        table[old] -= follow
        table[:, old] -= lead
        table[old, old] -= own
        np.maximum(table, 0, out=table)
        now = xlogx(table)
        # Wherever the unit goes, its neighbours' classes get back what they lost with it.
        rows, columns = table.sum(axis=1) + lead, table.sum(axis=0) + follow
        gain = (xlogx(table + follow) - now).sum(axis=1) + (xlogx(table.T + lead) - now.T).sum(axis=1)
        middle = np.diagonal(table)
        gain += xlogx(middle + follow + lead + own) + xlogx(middle)
        gain -= xlogx(middle + follow) + xlogx(middle + lead)
        gain -= xlogx(rows + follow.sum() + own) - xlogx(rows)
        gain -= xlogx(columns + lead.sum() + own) - xlogx(columns)
        # The end of a text stays alone in class 0.
        new = 1 + int(np.argmax(gain[1:]))
        classes[unit] = new
        table[new] += follow
        table[:, new] += lead
        table[new, new] += own
    return classes


def cluster(pairs: DataFrame, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Class of every unit, and the class bigram counts."""
    n = settings.classes
    classes = np.concatenate([[0], 1 + np.arange(settings.units - 1) % (n - 1)])
    alone = np.zeros(settings.units)
    for unit, times in pairs.where("u = v").select("u", "n").collect():
        alone[unit] = times
    for turn in range(settings.rounds):
        beside = beside_classes(pairs, classes, n)
        often = beside[0].sum(axis=1)
        half = [u for u in np.argsort(-often, kind="stable") if u and often[u] and u % 2 == turn % 2]
        classes = exchange(classes, beside, alone, np.array(half, int), n)
    after = beside_classes(pairs, classes, n)[0]
    table = np.zeros((n, n))
    np.add.at(table, classes, after)
    return classes, table


def smoothed(table: np.ndarray, settings: Settings) -> np.ndarray:
    """log10 of the transitions."""
    mass = settings.transition_mass
    sums = table.sum(axis=1, keepdims=True) + mass * settings.classes
    return np.log10((table + mass) / sums)


def likeliest(follow: np.ndarray, lead: np.ndarray, moves: np.ndarray, size: np.ndarray) -> np.ndarray:
    """For rows of counts of the classes after and before a word, the class it does best in."""
    gain = follow @ moves.T + lead @ moves - lead.sum(axis=1, keepdims=True) * size
    gain[:, 0] = -np.inf
    return gain.argmax(axis=1)


def join_classes(
    texts: DataFrame, words: list[bytes], classes: np.ndarray, table: np.ndarray, settings: Settings
) -> np.ndarray:
    """The class of every word of the lookup table, given those of the units.

    Words without a unit join the class where the neighbours they have in the texts are likeliest."""
    n, own = settings.classes, settings.unit_words
    found = np.array(classes[1 : 1 + min(own, len(words))])
    if len(words) <= own:
        return found
    by_ending = classes[1 + own :].tolist()
    # A number is the word's place after the units, or 0, and the class it has so far.
    given = {END: 0} | {word: int(classes[i]) for i, word in enumerate(words[:own], 1)}
    given |= {word: i * n + by_ending[settings.ending(word)] for i, word in enumerate(words[own:], 1)}

    def beside(line: np.ndarray) -> np.ndarray:
        place, cls = np.divmod(line, n)
        at = np.flatnonzero(place)
        return np.concatenate([place[at] * 2 * n + cls[at + 1], place[at] * 2 * n + n + cls[at - 1]])

    counted = counted_keys(texts, Codes(given, by_ending, settings), beside)
    moves, size = smoothed(table, settings), np.log10(np.maximum(table.sum(axis=0), 1))

    def best(batches):
        """All counts of a place come to one task, which sums them up as they come."""
        rows: dict[int, int] = {}
        sides = np.zeros((1024, 2 * n))
        for batch in batches:
            keys, times = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            places, at = np.unique(keys // (2 * n), return_inverse=True)
            row = np.array([rows.setdefault(place, len(rows)) for place in places.tolist()], int)
            while len(rows) > len(sides):
                sides = np.concatenate([sides, np.zeros_like(sides)])
            np.add.at(sides, (row[at], keys % (2 * n)), times)
        sides = sides[: len(rows)]
        cls = likeliest(sides[:, :n], sides[:, n:], moves, size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(rows), pa.int64()), pa.array(cls.astype(np.int32))], ["place", "class"]
        )

    place = F.floor(F.col("key") / (2 * n))
    joined = counted.repartition(place).mapInArrow(best, "place bigint, class int").toArrow()
    more = np.array([by_ending[settings.ending(word)] for word in words[own:]])
    more[joined.column(0).to_numpy() - 1] = joined.column(1).to_numpy()
    return np.concatenate([found, more])


@dataclass
class Model:
    """What scoring needs in every task, and the full word counts as a table."""

    counts: DataFrame
    settings: Settings
    looked_up: dict[bytes, int]
    word_classes: np.ndarray
    ending_classes: np.ndarray
    transitions: np.ndarray
    sizes: np.ndarray
    kinds: np.ndarray
    end_count: int
    n_tokens: int
    n_words: int

    def codes(self) -> Codes:
        """A number for every word: its place in the lookup table from 1, or 0, and its class."""
        n = self.settings.classes
        given = {word: i * n + int(c) for i, (word, c) in enumerate(zip(self.looked_up, self.word_classes, strict=True), 1)}
        return Codes(given, self.ending_classes.tolist(), self.settings)

    def class_of(self, word: bytes) -> int:
        return self.codes()[short_name(word)] % self.settings.classes


def frequent_words(counts: DataFrame, most: int) -> dict[bytes, int]:
    """At most `most` words, the most frequent ones, in order.

    Frequencies are counted by steps of a fraction of an octave, of which there are few hundred, and
    the step that crosses the bound by buckets of a hash of the word, so that no task sends more words
    to the driver than are taken."""
    words = counts.where(F.col("word") != F.lit(END)).withColumns(
        {
            "level": F.floor(F.log2("n") * 8),
            "bucket": F.pmod(F.xxhash64("word"), F.lit(HASH_BUCKETS)),
        }
    )
    room, wanted = most, F.lit(False)
    for level, size in sorted(map(tuple, words.groupBy("level").count().collect()), reverse=True):
        if size <= room:
            room -= size
            wanted = F.col("level") >= level
            continue
        last, crossing = 0, words.where(F.col("level") == level).groupBy("bucket").count()
        for bucket, n in sorted(map(tuple, crossing.collect())):
            if n > room:
                break
            room, last = room - n, bucket + 1
        wanted = wanted | ((F.col("level") == level) & (F.col("bucket") < last))
        break
    taken = words.where(wanted).select("word", "n").collect()
    return dict(sorted(((bytes(w), n) for w, n in taken), key=lambda x: (-x[1], x[0])))


def train(docs: DataFrame, text: str = "text", settings: Settings = Settings()) -> Model:
    """Learn from all documents given."""
    texts = docs.select(text_or_empty(text).alias("text"))
    counts = stored(word_counts(texts))
    n_tokens, n_words = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    end_count = counts.where(F.col("word") == F.lit(END)).select("n").first()
    looked_up = frequent_words(counts, settings.lookup_words)
    words = list(looked_up)
    pairs = stored(bigrams(texts, own_units(words, settings)))
    classes, table = cluster(pairs, settings)
    model = Model(
        counts,
        settings,
        looked_up,
        join_classes(texts, words, classes, table, settings),
        classes[1 + settings.unit_words :],
        table,
        np.zeros(settings.classes),
        np.zeros(settings.classes),
        end_count["n"] if end_count else 0,
        n_tokens,
        n_words,
    )
    n = settings.classes

    def moves(line: np.ndarray) -> np.ndarray:
        cls = line % n
        return cls[:-1] * n + cls[1:]

    found = summed(counted_keys(texts, model.codes(), moves, n * n)).toArrow()
    model.transitions = np.zeros((n, n))
    model.transitions.ravel()[found.column(0).to_numpy()] = found.column(1).to_numpy()
    # Words beyond the table by their endings; those in the table move to their own class.
    ending = F.crc32(F.substring("word", -settings.ending_bytes, settings.ending_bytes)) % settings.ending_units
    by_ending = (
        counts.where(F.col("word") != F.lit(END))
        .groupBy(ending.cast("int").alias("ending"))
        .agg(F.sum("n").alias("n"), F.count("*").alias("kinds"))
    )
    for row in by_ending.collect():
        model.sizes[model.ending_classes[row["ending"]]] += row["n"]
        model.kinds[model.ending_classes[row["ending"]]] += row["kinds"]
    for (word, times), cls in zip(looked_up.items(), model.word_classes.tolist(), strict=True):
        for own, change in ((cls, 1), (model.ending_classes[settings.ending(word)], -1)):
            model.sizes[own] += change * times
            model.kinds[own] += change
    model.sizes[0], model.kinds[0] = model.end_count, min(1, model.end_count)
    return model


def score_parts(texts: DataFrame, model: Model) -> DataFrame:
    """Per document one row with what tasks know, and one row per word they can't look up."""
    emission_base = np.log10(model.sizes + 0.5 * (model.kinds + 1))
    shared = texts.sparkSession.sparkContext.broadcast(
        (
            model.codes(),
            smoothed(model.transitions, model.settings),
            emission_base,
            np.log10(np.array([0, *model.looked_up.values()]) + 0.5),
            model.end_count,
        )
    )
    classes = model.settings.classes

    def parts(batches):
        codes, moves, base, logs, end_count = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, PART_ROWS):
                part = batch.slice(start, PART_ROWS)
                rows = part.num_rows
                values = np.zeros((2, rows))
                sums = np.zeros((2, rows), np.int64)
                others: list[bytes] = []
                times: list[int] = []
                owners = np.zeros(rows, np.int64)
                for at, text in enumerate(part.column(2).to_pylist()):
                    words = tokens(text)
                    place, line = np.divmod(codes.line(words), classes)
                    known = place[1:-1] > 0
                    found = place[1:-1][known]
                    sums[:, at] = len(words) + 1, len(found) + (end_count > 0)
                    values[:, at] = (
                        logs[found].sum() + np.log10(end_count + 0.5),
                        moves[line[:-1], line[1:]].sum() - base[line[1:]].sum(),
                    )
                    rest = Counter(compress(words, (~known).tolist()))
                    others.extend(map(short_name, rest))
                    times.extend(rest.values())
                    owners[at] = len(rest)
                of = pa.array(np.concatenate([np.arange(rows), np.repeat(np.arange(rows), owners)]))
                # A key of its own, which is no word, keeps a document's first row from meeting those of
                # others in one task, its copies' too.
                ids = zip(part.column(1).to_pylist(), part.column(0).to_pylist(), strict=True)
                keys = [f"\n{text_hash} {doc_id}".encode() for text_hash, doc_id in ids]
                blank = np.arange(rows + len(others)) >= rows

                def own(column, blank=blank):
                    whole = np.zeros(len(blank), column.dtype)
                    whole[: len(column)] = column
                    return pa.array(whole, mask=blank)

                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(of),
                        part.column(1).take(of),
                        pa.array(keys + others, pa.binary()),
                        pa.array(np.concatenate([np.zeros(rows, np.int64), np.array(times, np.int64)])),
                        *map(own, sums),
                        *map(own, values),
                    ],
                    ["doc_id", "text_hash", "word", "times", "tokens", "known", "counted", "moved"],
                )

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(
        parts,
        f"doc_id {kind}, text_hash bigint, word binary, times bigint, tokens bigint, known bigint, "
        "counted double, moved double",
    )


def score(docs: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    column = text_or_empty(text)
    texts = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(column).alias("text_hash"), column.alias("text")
    )
    times = F.col("times")
    looked = F.log10(F.coalesce("n", F.lit(0)) + F.lit(0.5)) * times
    summed_parts = (
        score_parts(texts, model)
        .join(model.counts, "word", "left")
        .groupBy("doc_id", "text_hash")
        .agg(
            F.count("tokens").alias("rows"),
            F.sum("tokens").alias("tokens"),
            F.sum(F.coalesce("known", F.when(F.col("n").isNotNull(), times), F.lit(0))).alias("known"),
            F.sum(F.coalesce("counted", looked)).alias("counted"),
            F.sum("moved").alias("moved"),
        )
    )
    rows = F.col("rows")
    n_tokens = F.col("tokens") / rows
    per_token = float(np.log10(model.n_tokens + 0.5 * (model.n_words + 1)))
    return summed_parts.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        n_tokens.cast("bigint").alias("n_tokens"),
        (F.col("known") / rows).cast("bigint").alias("n_known"),
        F.lit(model.n_tokens).cast("bigint").alias("train_tokens"),
        (F.col("counted") / rows - n_tokens * F.lit(per_token)).alias("base_score"),
        ((F.col("counted") + F.col("moved")) / rows).alias("score"),
        F.explode(F.array_repeat(F.lit(0), rows.cast("int"))).alias("_copy"),
    ).drop("_copy")

"""Phrase mining by sorting suffixes, and scores of how firmly the words of a phrase stick together.

Words are counted first. The most frequent get numbers that every task knows; the others keep their
spelling if they are frequent too, and the rest cut a piece as punctuation does, since no frequent
phrase holds them. Every word of a piece begins a suffix, cut after `longest` words. Tasks count
equal suffixes of their own texts and route them by two leading words, so all suffixes of a phrase
meet. Each route is sorted by multikey three-way quicksort: a partition is split by the word at its
depth into less, equal and greater; the equal part goes one word deeper, its weight is the count of
the phrase read so far, and any part that weighs less than wanted is abandoned unsorted. All partitions of a
route take their step together, in numpy. A route of too many suffixes is sorted in several
parts, whose counts are partial: nothing of them is abandoned until they are added up.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from chatlog.llm.workers import bounded_batches, parts
from chatlog.session import settled

LONGEST, LEAST, COVER_PERCENT, TOP = 3, 10, 50, 2000
#: Words that a task handles at once; suffixes of a route as planned, and at most before it is sorted in parts.
FLUSH, ROUTE, HOT_ROUTE = 500_000, 500_000, 2_000_000
OUT_ROWS = 50_000
#: Words with a number that every task holds, and their greatest length.
HEAD_WORDS, HEAD_BYTES = 200_000, 64
#: Bits, by checksum, that tell of a word without a number whether it may be frequent; a wrong yes costs room, no count.
TAIL_BITS = 1 << 26
#: Salts of the join with counts, and of the first round of the ranking.
SALTS, RANK_SALTS = 8, 32
_CUT = 0xFF  # stands for any cut between pieces; no UTF-8 text holds it
_BYTES = bytes(_CUT if c in b".,;:!?\n\x0b\x0c\r" else c + 32 if 65 <= c <= 90 else 32 if c == 9 else c for c in range(256))
_MARK = bytes([_CUT])


def pieces(text: str) -> list[bytes]:
    """The words of a text, with a mark wherever a piece ends. After translation only spaces are white space."""
    return text.encode().translate(_BYTES).replace(_MARK, b" \xff ").split()


def _numbered(batches: Iterator[pa.RecordBatch], number) -> Iterator[list[np.ndarray]]:
    """The texts of (lang, text) batches as word numbers, in stretches of about FLUSH words.

    `number(lang)` is the mapping of words to numbers; a negative number is a cut, and one stands behind each text.
    """
    held, n_held = [], 0
    for batch in batches:
        for part in parts(batch, 1):
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                found = pieces(text or "")
                held.append(np.fromiter(map(number(lang), found), np.int64, len(found)))
                held.append(np.array([-1]))
                n_held += len(found)
                if n_held >= FLUSH:
                    yield held
                    held, n_held = [], 0
    if n_held:
        yield held


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) over `docs` (lang, text), added up within tasks first; a null word stands for all words."""
    bounded_batches(docs.sparkSession)
    names = ["lang", "word", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, per_lang = count(), {}

        def number(lang):
            if lang not in per_lang:
                per_lang[lang] = defaultdict(numbers.__next__, {_MARK: -1})
            return per_lang[lang].__getitem__

        for held in _numbered(batches, number):
            ids = np.concatenate(held)
            n = np.bincount(ids[ids >= 0])
            for lang, d in per_lang.items():
                words = pa.array([w for w, i in d.items() if i >= 0], pa.binary()).cast(pa.string())
                each = n[np.fromiter((i for i in d.values() if i >= 0), np.int64, len(words))]
                for at in range(0, len(words), OUT_ROWS):
                    some = words[at:at + OUT_ROWS]
                    yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang, pa.string()), len(some)), some, pa.array(each[at:at + OUT_ROWS])], names=names)
                if len(words):
                    yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([None], pa.string()), pa.array([each.sum()])], names=names)
            numbers = count()
            per_lang.clear()

    return docs.mapInArrow(run, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _head(single: DataFrame) -> list[tuple[str, str]]:
    """At most HEAD_WORDS of the most frequent (lang, word), most frequent first."""
    able = single.filter(F.octet_length("word") <= HEAD_BYTES)
    room, least = HEAD_WORDS, 0
    if single.count() > HEAD_WORDS:  # the lowest count whose words all fit, from counts of counts
        sizes = able.groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy(F.col("n").desc()).limit(HEAD_WORDS + 1).collect()
        for n, words in sizes:
            if words > room:
                break
            room, least = room - words, n
        able = able.filter(F.col("n") >= least) if room < HEAD_WORDS else able.limit(0)
    rows = sorted((-n, lang, word) for lang, word, n in able.collect())
    return [(lang, word) for _, lang, word in rows]


def _tail(single: DataFrame, head: list[tuple[str, str]]) -> np.ndarray:
    """Set bits, by checksum of language and word, of all words of `single`; no bit if all are in `head`."""
    bits = np.zeros(TAIL_BITS // 64, np.int64)
    if single.count() > len(head):
        at = F.crc32(F.concat_ws(" ", "lang", "word")) % TAIL_BITS
        words = single.select(at.alias("_b")).selectExpr("_b DIV 64 AS _at", "shiftleft(1L, CAST(_b % 64 AS INT)) AS _bit")
        for i, bit in words.groupBy("_at").agg(F.bit_or("_bit")).toLocalIterator():  # TAIL_BITS / 64 rows at most
            bits[i] = bit
    return bits


def _may_be_frequent(words: list[str], bits: np.ndarray) -> np.ndarray:
    at = np.array([zlib.crc32(w.encode()) for w in words], np.int64) % TAIL_BITS
    return (bits[at // 64] >> at % 64 & 1).astype(bool)


def _packed(ids: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct suffixes of two words and more of a stretch of word numbers: a row of `longest` numbers each, and how often."""
    padded = np.concatenate((ids, np.full(longest, -1)))
    at = np.flatnonzero((ids >= 0) & (padded[1:len(ids) + 1] >= 0))
    columns = [ids[at]]
    for d in range(1, longest):
        columns.append(np.where(columns[-1] >= 0, padded[at + d], -1))
    bits = int(ids.max(initial=0) + 2).bit_length()
    key, width = columns[0], bits
    for column in columns[1:]:
        if width + bits > 62:  # number the keys so far, and go on with the numbers
            _, key = np.unique(key, return_inverse=True)
            width = int(key.max(initial=0) + 1).bit_length()
        key, width = key << bits | column + 1, width + bits
    _, first, n = np.unique(key, return_index=True, return_counts=True)
    return np.stack([c[first] for c in columns], 1), n


def _bytes(rows: np.ndarray, n: np.ndarray) -> bytes:
    """Suffixes in order and their counts as one compressed value: first words by difference, bytes by place."""
    columns = np.stack([np.diff(rows[:, 0], prepend=0), *(rows.T[1:] + 1), n], 1).astype("<i4")
    return pa.compress(np.ascontiguousarray(columns.view(np.uint8).T).tobytes(), "zstd", asbytes=True)


def _rows(packed: bytes, size: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """What `_bytes` was given."""
    width = 4 * (longest + 1)
    raw = np.frombuffer(pa.decompress(packed, size * width, "zstd", asbytes=True), np.uint8).reshape(width, size)
    columns = np.ascontiguousarray(raw.T).view("<i4").astype(np.int64)
    return np.concatenate((np.cumsum(columns[:, :1], 0), columns[:, 1:-1] - 1), 1), columns[:, -1]


def suffixes(docs: DataFrame, head: list[tuple[str, str]], tail: np.ndarray, routes: int, longest: int = LONGEST) -> DataFrame:
    """(route, size, packed, words) of `docs` (lang, text): the suffixes of a route in a task's stretch of text.

    `packed` holds `size` suffixes as word numbers, -1 behind the end of a piece, and how often each occurs.
    Numbers from len(head) on are entries of `words`, as language, space, word; of those without a bit in `tail` each is a cut.
    """
    bounded_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast((head, tail))
    names, known = ["route", "size", "packed", "words"], len(head)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: dict[str, dict[bytes, int]] = {}
        heads_of, bits = sent.value
        for i, (lang, word) in enumerate(heads_of):
            given.setdefault(lang, {})[word.encode()] = i
        numbers, others = count(known), {}

        def number(lang):
            heads = given.get(lang, {})
            if lang not in others:
                others[lang] = defaultdict(numbers.__next__, {_MARK: -1})
            mine = others[lang]
            return lambda w: heads[w] if w in heads else mine[w]

        for held in _numbered(batches, number):
            spelled = [f"{lang} {w.decode()}" for lang, d in others.items() for w, i in d.items() if i >= 0]
            places = np.array([i for d in others.values() for i in d.values() if i >= 0], np.int64)
            kept = _may_be_frequent(spelled, bits)
            words = np.array(spelled, object)[kept]
            renumbered = np.full(known + len(spelled) + 1, -1)  # the last one stands for -1
            renumbered[:known] = np.arange(known)
            renumbered[places[kept]] = known + np.arange(len(words))
            rows, n = _packed(renumbered[np.concatenate(held)], longest)
            numbers = count(known)
            others.clear()
            if not len(rows):
                continue
            marks = np.concatenate((np.arange(known, dtype=np.int64), [known + zlib.crc32(w.encode()) for w in words])).astype(np.uint64)
            lead = marks[rows[:, 0]] * np.uint64(0x9E3779B97F4A7C15) + marks[rows[:, 1]] * np.uint64(0xC2B2AE3D27D4EB4F)
            route = ((lead ^ lead >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(20)) % np.uint64(routes)
            order = np.argsort(route, kind="stable")
            rows, n, route = rows[order], n[order], route[order]
            starts = np.flatnonzero(np.concatenate(([True], route[1:] != route[:-1])))
            ends = np.append(starts[1:], len(route))
            spelt = []
            if len(words):  # numbers from `known` on count within the row from here
                for a, b in zip(starts, ends):
                    some = rows[a:b]
                    used, place = np.unique(some[some >= known], return_inverse=True)
                    some[some >= known] = known + place
                    spelt.append(words[used - known].tolist())
            else:
                spelt = [[]] * len(starts)
            made = pa.RecordBatch.from_arrays(
                [pa.array(route[starts].astype(np.int64)), pa.array(ends - starts),
                 pa.array([_bytes(rows[a:b], n[a:b]) for a, b in zip(starts, ends)], pa.binary()), pa.array(spelt, pa.list_(pa.string()))], names=names)
            for at in range(0, made.num_rows, 1000):
                yield made.slice(at, 1000)

    return docs.mapInArrow(run, "route bigint, size bigint, packed binary, words array<string>")


def equal_parts(keys: np.ndarray, weights: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(depth, row, weight) of every equal partition of the rows of `keys` that weighs `least` or more.

    Depth d is a partition equal in d leading numbers, `row` one of its rows. A negative
    number is the end of a row and begins no partition.
    """
    deepest = keys.shape[1]
    rows, starts, depth = np.arange(len(keys)), np.array([0]), np.array([0])
    found = [(np.zeros(0, np.int64),) * 3]
    while len(rows):
        sizes = np.diff(np.append(starts, len(rows)))
        part = np.repeat(np.arange(len(starts)), sizes)
        key = keys[rows, depth[part]]
        a, b, c = key[starts], key[starts + sizes // 2], key[starts + sizes - 1]
        pivot = np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))  # median of three
        side = np.sign(key - pivot[part]) + 1
        order = np.argsort(part * 3 + side, kind="stable")
        rows, group = rows[order], (part * 3 + side)[order]
        starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        weight = np.add.reduceat(weights[rows], starts)
        old, equal = group[starts] // 3, group[starts] % 3 == 1
        depth = depth[old] + equal
        read = equal & (pivot[old] >= 0) & (weight >= least)
        found.append((depth[read], rows[starts[read]], weight[read]))
        kept = (weight >= least) & np.where(equal, read & (depth < deepest), True)
        sizes = np.diff(np.append(starts, len(rows)))
        rows = rows[np.repeat(kept, sizes)]
        depth, sizes = depth[kept], sizes[kept]
        starts = np.cumsum(sizes) - sizes
    return tuple(np.concatenate(c) for c in zip(*found))


def phrase_counts(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, n) of all phrases of 1 to `longest` words with n >= `least`; and (lang, n), all words."""
    every = settled(word_counts(docs).filter(F.col("word").isNull() | (F.col("n") >= least)))
    totals, single = every.filter("word IS NULL").drop("word"), every.filter("word IS NOT NULL")
    ones = single.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("words"), "n")
    if longest < 2:
        return ones, totals
    head = _head(single)
    routes = max(1, (totals.agg(F.sum("n")).collect()[0][0] or 0) // ROUTE)
    packed = settled(suffixes(docs, head, _tail(single, head), routes, longest))
    hot = settled(packed.groupBy("route").agg(F.sum("size").alias("_rows")).filter(F.col("_rows") > HOT_ROUTE))
    spread = F.when(F.col("_rows").isNotNull(), F.pmod(F.xxhash64("packed"), F.ceil(F.col("_rows") / ROUTE)))
    routed = packed.join(hot, "route", "left").select("route", spread.alias("_spread"), "size", "packed", "words")
    sent, known = docs.sparkSession.sparkContext.broadcast(head), len(head)

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        spelled: dict[str, int] = {}
        every_key, every_n = [], []
        for size, packed, words in zip(*[rows.column(c).to_pylist() for c in ("size", "packed", "words")]):
            mine, n = _rows(packed, size, longest)
            if words:
                numbers = np.array([known + spelled.setdefault(w, len(spelled)) for w in words])
                mine[mine >= known] = numbers[mine[mine >= known] - known]
            every_key.append(mine)
            every_n.append(n)
        keys, weights = np.concatenate(every_key), np.concatenate(every_n)
        depth, at, weight = equal_parts(keys, weights, least if key[1].as_py() is None else 1)
        depth, at, weight = depth[depth > 1], at[depth > 1], weight[depth > 1]
        listed = list(spelled)
        pairs = {i: sent.value[i] if i < known else tuple(listed[i - known].rsplit(" ", 1)) for i in np.unique(keys[at]).tolist() if i >= 0}
        phrases = [[pairs[i] for i in row[:d]] for d, row in zip(depth.tolist(), keys[at].tolist())]
        return pa.table({"lang": pa.array([p[0][0] for p in phrases], pa.string()),
                         "phrase": pa.array([" ".join(w for _, w in p) for p in phrases], pa.string()),
                         "words": pa.array(depth, pa.int32()), "n": pa.array(weight, pa.int64())})

    found = routed.groupBy("route", "_spread").applyInArrow(run, "lang string, phrase string, words int, n bigint")
    found = found.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    return ones.unionByName(found), totals


def _score(a: str, left: str, right: str):
    """floor(1000000 * a * a / (left * right)), exactly."""
    wide = lambda c: f"CAST({c} AS DECIMAL(19, 0))"
    return F.expr(f"CAST((1000000 * ({wide(a)} * {wide(a)})) DIV ({wide(left)} * {wide(right)}) AS BIGINT)")


def collocations(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, cover_percent: int = COVER_PERCENT, top: int = TOP,
    lang_col: str = "lang", text_col: str = "text",
) -> DataFrame:
    """Per language its `top` phrases: lang, rank, phrase, a, l, r, n, score.

    Words are lower-cased in A-Z and phrases stay within pieces between `. , ; : ! ?` and line
    ends. a is how often the phrase of 2 to `longest` words occurs, overlaps included, `least` at
    the fewest; l and r the same of its two parts at the cut where 1000000 a a / (l r), floored, is
    lowest, ties to the shorter first part; n all words of the language. Phrases inside a longer one
    that occurs at least `cover_percent` % as often are left out. Order: score, a, both descending, phrase
    in byte order. A null language is `und`, null texts and texts without words add nothing, an
    empty table gives no rows; repeated rows count again. Only the two columns named are read.
    """
    rows = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    counts, totals = phrase_counts(rows, longest, least)
    counts = settled(counts)
    candidates = counts.filter("words > 1").select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("_w"))
    cuts = candidates.select("lang", "phrase", "a", "_w", F.explode(F.sequence(F.lit(1), F.size("_w") - 1)).alias("_k"))
    cuts = cuts.withColumn("_left", F.array_join(F.slice("_w", F.lit(1), F.col("_k")), " ")).withColumn(
        "_right", F.array_join(F.slice("_w", F.col("_k") + 1, F.size("_w") - F.col("_k")), " ")).drop("_w")
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    salts = F.when(F.col("words") == 1, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    for side, name in (("_left", "l"), ("_right", "r")):  # many phrases share a word, so words are there once per salt
        part = counts.select("lang", F.col("phrase").alias(side), F.col("n").alias(name), F.explode(salts.cast("array<bigint>")).alias("_salt"))
        salted = cuts.withColumn("_salt", F.when(F.contains(F.col(side), F.lit(" ")), 0).otherwise(salt))
        cuts = salted.join(part, ["lang", side, "_salt"]).drop("_salt")
    lowest = F.min(F.struct(_score("a", "l", "r").alias("score"), "_k", "l", "r")).alias("_x")
    scored = cuts.groupBy("lang", "phrase", "a").agg(lowest).select("lang", "phrase", "a", "_x.l", "_x.r", "_x.score")

    if longest > 2:
        inner = F.flatten(F.transform(F.sequence(F.lit(2), F.size("_w") - 1), lambda m: F.transform(
            F.sequence(F.lit(1), F.size("_w") - m + 1), lambda i: F.array_join(F.slice("_w", i, m), " "))))
        covers = candidates.filter(F.size("_w") > 2).select("lang", F.explode(inner).alias("phrase"), "a")
        covers = covers.groupBy("lang", "phrase").agg(F.max("a").alias("_over"))
        scored = scored.join(covers, ["lang", "phrase"], "left").filter(
            F.col("_over").isNull() | (F.col("_over") * 100 < F.col("a") * cover_percent)).drop("_over")

    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salted = scored.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(RANK_SALTS)))
    few = salted.withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))).filter(F.col("_r") <= top)
    best = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).filter(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

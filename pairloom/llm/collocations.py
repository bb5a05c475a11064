"""Phrase collocation mining: level by level with broadcast double-array tries."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.hashing import mix
from pairloom.llm.positions import with_running_sums
from pairloom.llm.text import ascii_lower
from pairloom.scratch import BROADCAST_BYTES, stage

if TYPE_CHECKING:  # tasks need no pandas, which takes some 30 MB of each Python process
    import pandas as pd

# Signs that end a piece, and words between blanks inside of one; A to Z lower-cased.
_TOKEN = re.compile(rb"[.,;:!?\x0A-\x0D]+|[^\x20\x09.,;:!?\x0A-\x0D]+")
_BREAK = re.compile(rb"[\x20\x09.,;:!?\x0A-\x0D]")
WORD = r"[^\x20\x09.,;:!?\x0A-\x0D]+"
UNKNOWN_LANG = "und"

_PIECE = 1 << 20
# Words of one sequence before the next begins: ten thousand rows, which Arrow sends at once, are some 10 MB. Positions
# that are stepped at once, and entries that a task holds before it sends them on.
_SEQUENCE = 1 << 8
_STEP = 1 << 18
_HELD = 1 << 20
_SLICES = 64
_FREE, _TAKEN = -1, -2
_WINDOW = 512


def tokens_of(text: bytes) -> Iterator[list[bytes]]:
    """Words, and runs of signs between pieces, some at a time; no word is cut."""
    lowered, at = text.lower(), 0
    while at < len(lowered):
        stop = _BREAK.search(lowered, at + _PIECE)
        end = stop.start() if stop else len(lowered)
        yield _TOKEN.findall(lowered, at, end)
        at = end


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
    for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
        yield lang, text.as_buffer().to_pybytes()


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts).astype(np.int32) if parts else np.empty(0, np.int32)))


def _sequences(batches: Iterator[pa.RecordBatch], name: str = "ids") -> Iterator[np.ndarray]:
    for batch in batches:
        lists = batch.column(name)
        flat, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
        for k in range(batch.num_rows):
            yield flat[offsets[k] : offsets[k + 1]]


def _stretches(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The sequences of a batch, which end with a zero each, as stretches that share one position with the next."""
    lists = batch.column("ids")
    ends = lists.offsets.to_numpy()
    flat = lists.values.to_numpy()[ends[0] : ends[-1]]
    for low in range(0, len(flat), _STEP):
        yield flat[low : low + _STEP + 1]


def word_counts(rows: DataFrame) -> DataFrame:
    """``(lang, word, f)`` over whole texts, summed in each task before the shuffle."""
    words = F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(WORD), F.lit(0))
    return rows.select("lang", F.explode(words).alias("word")).groupBy("lang", "word").agg(F.count(F.lit(1)).alias("f"))


def _collapsed(ids: np.ndarray) -> np.ndarray:
    """Without zeros at the ends, and with one for each run of zeros."""
    kept = ids > 0
    kept[1:] |= ids[:-1] > 0
    ids = ids[kept]
    return ids[:-1] if len(ids) and not ids[-1] else ids


def _gathered(parts: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Collapsed sequences with a zero behind each, gathered to rows of some words and batches of some rows."""
    rows, held, size, total = [], [], 0, 0
    for ids in parts:
        ids = _collapsed(ids)
        if len(ids) > 1:  # a lone phrase has no neighbour
            held += [ids, np.zeros(1, np.int32)]
            size += len(ids) + 1
        if size >= _SEQUENCE:
            rows.append(np.concatenate(held))
            total, held, size = total + size, [], 0
        if total >= _STEP:
            yield pa.RecordBatch.from_arrays([_lists(rows)], names=["ids"])
            rows, total = [], 0
    rows += [np.concatenate(held)] if held else []
    if rows:
        yield pa.RecordBatch.from_arrays([_lists(rows)], names=["ids"])


def _encoded(rows: DataFrame, words: DataFrame, count: int, most: int) -> DataFrame:
    """``(ids)``: texts as the numbers of their frequent words, zero for a sign or another word.

    A dictionary has ``most`` words at most; more words are put in by several dictionaries, one after the other.
    """
    size = words.agg(F.sum(F.octet_length("phrase") + 16).alias("bytes")).first()["bytes"] or 0
    shards = max(1, -(-count // most), -(-size // BROADCAST_BYTES))
    step = -(-count // shards)
    rows = rows.select("lang", "text", F.array().cast("array<int>").alias("ids"))
    for shard in range(shards):
        known: dict[str, dict[bytes, int]] = {}
        # Bounded by ``most``.
        for row in words.filter((F.col("id") > shard * step) & (F.col("id") <= (shard + 1) * step)).select("lang", "phrase", "id").collect():
            known.setdefault(row["lang"], {})[row["phrase"].encode()] = row["id"]
        shared = rows.sparkSession.sparkContext.broadcast(known)
        last = shard == shards - 1

        def ids_of(batch: pa.RecordBatch, shared=shared) -> Iterator[np.ndarray]:
            for (lang, text), before in zip(_texts(batch), _sequences([batch]), strict=True):
                known = shared.value.get(lang, {})
                parts = [np.fromiter((known.get(token, 0) for token in tokens), np.int32, len(tokens)) for tokens in tokens_of(text)]
                ids = np.concatenate(parts) if parts else np.empty(0, np.int32)
                yield np.where(before > 0, before, ids) if len(before) else ids

        def finish(batches: Iterator[pa.RecordBatch], ids_of=ids_of) -> Iterator[pa.RecordBatch]:
            yield from _gathered(ids for batch in batches for ids in ids_of(batch))

        def fill(batches: Iterator[pa.RecordBatch], ids_of=ids_of) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("text"), _lists(list(ids_of(batch)))], names=["lang", "text", "ids"])

        rows = rows.mapInArrow(finish, "ids array<int>") if last else rows.mapInArrow(fill, "lang string, text binary, ids array<int>")
    return rows


class DoubleArrayTrie:
    """Children of numbered states in two arrays: the child of ``s`` by digit ``d`` is at ``base[s] + d`` if ``check`` there is ``s``.

    A code is two digits, so that children of a state lie close together. States 1 to ``states`` are the
    parents; the places of their children's children are the accepting states.
    """

    def __init__(self, parents: np.ndarray, codes: np.ndarray, states: int, highest: int):
        self.radix = int(np.ceil(np.sqrt(highest + 1)))
        order = np.lexsort((codes, parents))
        parents, codes = parents[order].astype(np.int64), codes[order].astype(np.int64)
        self._check = np.full(states + 2 * self.radix + 3 * len(codes) + _WINDOW, _FREE, np.int32)
        self._base = np.zeros(len(self._check), np.int32)
        self._check[: states + 1] = _TAKEN
        self._least = states + 1
        high, low = codes // self.radix, codes % self.radix
        edges = parents * (self.radix + 1) + high
        first = np.flatnonzero(np.diff(edges, prepend=-1))
        middles = self._place(parents[first], high[first])
        places = self._place(np.repeat(middles, np.diff(np.append(first, len(edges)))), low)
        #: Where each given (parent, code) is accepted.
        self.places = np.empty(len(codes), np.int64)
        self.places[order] = places
        end = int(max(places.max(initial=0), middles.max(initial=0), states)) + 1
        # The last place belongs to nobody: digits that lead out of the arrays end there.
        self.base, self.check = self._base[: end + 1].copy(), np.append(self._check[:end], _TAKEN).astype(np.int32)
        self.base[end] = 0
        del self._base, self._check

    def _room(self, size: int) -> None:
        if size > len(self._check):
            more = max(size, 2 * len(self._check)) - len(self._check)
            self._check = np.append(self._check, np.full(more, _FREE, np.int32))
            self._base = np.append(self._base, np.zeros(more, np.int32))

    def _place(self, parents: np.ndarray, digits: np.ndarray) -> np.ndarray:
        """Find a base for each parent (they stand together); where each digit's child is."""
        first = np.flatnonzero(np.diff(parents, prepend=-1))
        sizes = np.diff(np.append(first, len(parents)))
        places = np.empty(len(parents), np.int64)
        cursor, at, size = self._least, self._least, 0
        for k in np.argsort(-sizes, kind="stable")[: int((sizes > 1).sum())]:
            own = digits[first[k] : first[k] + sizes[k]]
            # Where one of this size did not fit, another hardly will.
            at, size = (at if len(own) == size else cursor), len(own)
            while True:
                self._room(at + _WINDOW + self.radix)
                free = at + np.flatnonzero(self._check[at : at + _WINDOW] == _FREE)
                fits = (self._check[free[:, None] - own[0] + own[None, :]] == _FREE).all(axis=1)
                if fits.any():
                    break
                # Nearly full stretches are left to single children.
                cursor = at + _WINDOW if at == cursor and len(free) < _WINDOW // 8 else cursor
                at += _WINDOW
            base = int(free[np.argmax(fits)]) - int(own[0])
            self._check[base + own] = parents[first[k]]
            self._base[parents[first[k]]] = base
            places[first[k] : first[k] + sizes[k]] = base + own
        alone = first[sizes == 1]
        free = self._least + np.flatnonzero(self._check[self._least :] == _FREE)
        if len(free) < len(alone):
            self._room(len(self._check) + len(alone))
            free = self._least + np.flatnonzero(self._check[self._least :] == _FREE)
        free = free[: len(alone)]
        self._check[free], self._base[parents[alone]], places[alone] = parents[alone], free - digits[alone], free
        return places

    def step(self, states: np.ndarray, digits: np.ndarray) -> np.ndarray:
        """The children of all states at once, the last place where there is none."""
        last = len(self.check) - 1
        to = self.base[states].astype(np.int64) + digits
        to[(to < 0) | (to > last)] = last
        to[self.check[to] != states] = last
        return to

    def accept(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The accepting states of all positions, the last place where there is none. A code of zero leads nowhere."""
        to = self.step(self.step(states, codes // self.radix), codes % self.radix)
        to[(codes == 0) | (states == 0)] = len(self.check) - 1
        return to

    def pairs(self, parents: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each accepting state its parent and code."""
        of, code = np.zeros(len(self.check), np.int64), np.zeros(len(self.check), np.int64)
        of[self.places], code[self.places] = parents, codes
        return of, code


def _hashed(states: np.ndarray, following: np.ndarray, bits: int) -> np.ndarray:
    keys = (states.astype(np.uint64) << np.uint64(32)) | following.astype(np.uint64)
    return (mix(keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def _pairs_of(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Neighbours of which both are frequent."""
    both = (ids[:-1] > 0) & (ids[1:] > 0)
    return ids[:-1][both], ids[1:][both]


def _often(rows: DataFrame, bits: int, least: int) -> np.ndarray:
    """Which of ``2 ** bits`` counters of neighbours reach ``least``, as packed bits. Tasks hold counters that stop at their highest value."""
    kind = np.uint8 if least <= 255 else np.uint32
    width = (1 << bits) // _SLICES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters, most = np.zeros(1 << bits, kind), np.iinfo(kind).max
        for batch in batches:
            for ids in _stretches(batch):
                at, n = np.unique(_hashed(*_pairs_of(ids), bits), return_counts=True)
                counters[at] = np.minimum(counters[at] + n, most)
        for k in range(_SLICES):
            part = counters[k * width : (k + 1) * width]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["slice", "data"])

    def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for part in parts:
            for slice_, data in zip(part.column("slice").to_pylist(), part.column("data"), strict=True):
                sums[slice_] = sums.get(slice_, 0) + np.frombuffer(data.as_buffer(), kind).astype(np.int64)
        bits = [np.packbits(s >= least).tobytes() for s in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(bits, pa.binary())], names=["slice", "data"])

    packed = np.zeros((1 << bits) // 8, np.uint8)
    summed = rows.mapInArrow(count, "slice int, data binary").repartition(_SLICES, "slice").mapInArrow(add, "slice int, data binary")
    for row in summed.collect():
        packed[row["slice"] * width // 8 : (row["slice"] + 1) * width // 8] = np.frombuffer(row["data"], np.uint8)
    return packed


def _candidates(rows: DataFrame, bits: int, often: np.ndarray) -> DataFrame:
    """``(a, b)``: neighbours that occur, both frequent, with a counter that may belong to a frequent pair."""
    shared = rows.sparkSession.sparkContext.broadcast(often)

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> pa.RecordBatch:
            keys = np.unique(np.concatenate(held)) if held else np.empty(0, np.int64)
            return pa.RecordBatch.from_arrays([pa.array((keys >> 32).astype(np.int32)), pa.array((keys & 0xFFFFFFFF).astype(np.int32))], names=["a", "b"])

        for ids in (part for batch in batches for part in _stretches(batch)):
            a, b = _pairs_of(ids)
            at = _hashed(a, b, bits)
            some = (shared.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0
            held.append(np.unique((a[some].astype(np.int64) << 32) | b[some]))
            size += len(held[-1])
            if size > _HELD:
                held = [np.unique(np.concatenate(held))]
                size = len(held[0])
                if size > _HELD // 2:
                    yield out()
                    held, size = [], 0
        yield out()

    return rows.mapInArrow(distinct, "a int, b int").distinct()


def _tries(pairs: DataFrame, states: int, most: int, *columns: str) -> Iterator[tuple[DoubleArrayTrie, pd.DataFrame]]:
    """Tries of ``most`` pairs (a, b) each, about: the pairs are dealt by hash."""
    count = pairs.count()
    shards = -(-count // most)
    for shard in range(shards):
        part = pairs.filter(F.pmod(F.xxhash64("a", "b"), F.lit(shards)) == shard).select("a", "b", *columns).toPandas()
        if len(part):
            yield DoubleArrayTrie(part["a"].to_numpy(np.int64), part["b"].to_numpy(np.int64), states, states), part


def _counted(rows: DataFrame, candidates: DataFrame, states: int, most: int) -> tuple[DataFrame, DoubleArrayTrie | None]:
    """``(a, b, f)``: how often each candidate occurs, and the trie if there is one only. One pass over the sequences for each trie."""
    spark, out, only = rows.sparkSession, None, None
    for number, (trie, part) in enumerate(_tries(candidates, states, most)):
        only = None if number else trie
        of, code = trie.pairs(part["a"].to_numpy(np.int64), part["b"].to_numpy(np.int64))
        shared = spark.sparkContext.broadcast((trie, of.astype(np.int32), code.astype(np.int32)))

        def count(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            trie, of, code = shared.value
            sums = np.zeros(len(trie.check), np.int64)
            for ids in (part for batch in batches for part in _stretches(batch)):
                sums += np.bincount(trie.accept(ids[:-1], ids[1:]), minlength=len(sums))
            sums[-1] = 0
            some = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(of[some]), pa.array(code[some]), pa.array(sums[some])], names=["a", "b", "f"])

        found = rows.mapInArrow(count, "a int, b int, f long")
        out = found if out is None else out.unionByName(found)
    out = spark.createDataFrame([], "a int, b int, f long") if out is None else out
    return out.groupBy("a", "b").agg(F.sum("f").alias("f")), only


def _recoded(rows: DataFrame, phrases: DataFrame, states: int, most: int, only: DoubleArrayTrie | None) -> DataFrame:
    """``(ids)``: sequences of the frequent phrases that begin at each position, one word longer than before."""
    spark = rows.sparkSession
    rows = rows.select("ids", F.array().cast("array<int>").alias("longer"))
    # The trie of all candidates serves again when it was the only one.
    tries = _tries(phrases, states, most, "id") if only is None else iter([(only, phrases.select("a", "b", "id").toPandas())])
    following = next(tries, None)
    while following:
        (trie, part), following = following, next(tries, None)
        named = np.zeros(len(trie.check), np.int32)
        named[trie.accept(part["a"].to_numpy(np.int64), part["b"].to_numpy(np.int64))] = part["id"]
        shared = spark.sparkContext.broadcast((trie, named))

        def fill(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            trie, named = shared.value
            for batch in batches:
                # As long as the sequence; nothing begins at the zero in its end.
                found = [named[trie.accept(ids, np.append(ids[1:], 0))][:_STEP] for ids in _stretches(batch)]
                found = np.concatenate(found) if found else np.empty(0, np.int32)
                before, lists = batch.column("longer"), batch.column("ids")
                if len(before.values):
                    found = np.maximum(found, before.values.to_numpy()[before.offsets.to_numpy()[0] :][: len(found)])
                offsets = pa.array((lists.offsets.to_numpy() - lists.offsets.to_numpy()[0]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([lists, pa.ListArray.from_arrays(offsets, pa.array(found))], names=["ids", "longer"])

        def finish(batches: Iterator[pa.RecordBatch], fill=fill) -> Iterator[pa.RecordBatch]:
            yield from _gathered(_sequences(fill(batches), "longer"))

        # The last trie's task gathers, too: a step of its own would be another Python process beside each.
        if not following:
            return rows.mapInArrow(finish, "ids array<int>")
        rows = rows.mapInArrow(fill, "ids array<int>, longer array<int>")
    return rows.select("ids").limit(0)


def _numbered(df: DataFrame, order: list[str]) -> DataFrame:
    return with_running_sums(df, order, []).withColumn("id", (F.col("position") + 1).cast("int")).drop("position")


def _scored(level: DataFrame, length: int) -> DataFrame:
    """The cut of lowest score. ``head`` and ``tail`` have the counts of the first and last 1, 2, ... words."""
    a, n = F.col("f").cast("decimal(19,0)"), F.col("n").cast("decimal(15,0)")
    cuts = []
    for k in range(1, length):
        l, r = F.element_at("head", k), F.element_at("tail", length - k)
        product = (F.lit(1000).cast("decimal(4,0)") * a * n).alias("top"), (l.cast("decimal(19,0)") * r.cast("decimal(19,0)")).alias("bottom")
        score = F.call_function("div", product[0], product[1])
        cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), l.alias("l"), r.alias("r")))
    best = F.array_min(F.array(*cuts))
    return level.withColumn("best", best).select("lang", "phrase", F.col("f").alias("a"), F.col("best.l").alias("l"), F.col("best.r").alias("r"), "n", F.col("best.score").alias("score"))


def _joined(df: DataFrame, phrases: DataFrame, size: int, key: str) -> DataFrame:
    side = F.broadcast(phrases) if size <= BROADCAST_BYTES else phrases
    return df.join(side, key)


def mine_collocations(
    docs: DataFrame,
    *,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = 100,
    longest: int = 5,
    top: int = 2000,
    inside_percent: int = 100,
    sketch_bits: int = 24,
    trie_size: int = 500_000,
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` collocations of each language.

    Texts are split at ``. , ; : ! ?`` and ends of lines into pieces, and those into words between blanks, A to Z
    lower-cased. Candidates are phrases of 2 to ``longest`` words that occur at least ``least`` times inside pieces of
    a language, overlaps included. A cut of a phrase scores ``(1000 a n) div (l r)``, with ``a`` the count of the
    phrase, ``l`` and ``r`` those of its parts and ``n`` of all words; the lowest-scoring cut counts, of equal ones the first.
    A candidate goes when a longer one that holds it has at least ``inside_percent`` hundredths of its count. Order:
    score and ``a`` falling, then the phrase by its bytes. All numbers are exact; products are decimals.

    Level by level: texts become sequences of numbers of frequent words, and from level to level of frequent phrases one word
    longer that begin at each position, with a zero for anything else. A phrase is frequent only when the phrases without its
    last and without its first word are, so the candidates of a level are neighbours in such a sequence; a
    fixed number of counters (``2 ** sketch_bits`` at most) leaves out most of those that are not frequent. Candidates
    are broadcast as double-array tries of about ``trie_size`` candidates each. Tasks step the states of all positions of
    a sequence at once, count accepting states, and the counts of all tasks are added up. More candidates take
    more tries and passes, not more memory. A longer candidate that holds another has one between them
    that is one word longer, so covering is decided between neighbouring levels.

    A null language counts as ``und``, a null text as empty. Rows need no id; each one counts, repeated or not. Very long texts
    are taken whole, in pieces that cut no word. Other columns are not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN_LANG))
    rows = docs.select(lang.alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    words = stage(word_counts(rows), "colloc-words").df
    rows = rows.withColumn("text", F.col("text").cast("binary"))
    # One row for each language.
    totals = stage(words.groupBy("lang").agg(F.sum("f").alias("n")), "colloc-totals")
    level = _numbered(words.filter(F.col("f") >= least).withColumnRenamed("word", "phrase"), ["lang", "phrase"])
    level = level.join(totals.df, "lang").select("id", "lang", "phrase", F.col("phrase").alias("last"), "n", "f", F.array("f").alias("head"), F.array("f").alias("tail"))
    level = stage(level, "colloc-level").df
    facts = _facts(level)
    results, sequences = [], None
    for length in range(2, longest + 1):
        if not facts["phrases"]:
            break
        states = facts["phrases"]
        if sequences is None:
            sequences = stage(_encoded(rows, level, states, trie_size), "colloc-sequences")
        bits = min(sketch_bits, max(12, int(np.ceil(np.log2(max(1, facts["places"] / 8))))))
        # A task for each core: each sends its counters and candidates once, however many files it reads.
        held = sequences.df.coalesce(spark.sparkContext.defaultParallelism)
        often = _often(held, bits, least)
        candidates = stage(_candidates(held, bits, often), "colloc-candidates")
        counted, only = _counted(held, candidates.df, states, trie_size)
        pairs = stage(_numbered(counted.filter(F.col("f") >= least), ["a", "b"]), "colloc-pairs").df
        if length < longest:
            longer = stage(_recoded(sequences.df, pairs, states, trie_size, only), "colloc-sequences")
        first = level.select(F.col("id").alias("a"), "lang", "n", F.col("phrase").alias("start"), F.col("head").alias("heads"), F.col("f").alias("fa"))
        second = level.select(F.col("id").alias("b"), "last", F.col("tail").alias("tails"), F.col("f").alias("fb"))
        joined = _joined(_joined(pairs, first, facts["bytes"], "a"), second, facts["bytes"], "b")
        count = F.array("f")
        joined = joined.select(
            "id", "a", "b", "fa", "fb", "lang", F.concat_ws(" ", "start", "last").alias("phrase"), "last", "n", "f", F.concat("heads", count).alias("head"), F.concat("tails", count).alias("tail")
        )
        joined = stage(joined, "colloc-level").df
        if length > 2:
            covered = [joined.filter(F.lit(100) * F.col("f") >= F.lit(inside_percent) * F.col(f"f{x}")).select(F.col(x).alias("id")) for x in "ab"]
            results.append(_scored(level.join(covered[0].unionByName(covered[1]).distinct(), "id", "left_anti"), length - 1))
        sequences.drop()
        candidates.drop()
        level, facts = joined.drop("a", "b", "fa", "fb"), _facts(joined)
        if length < longest:
            sequences = longer
        else:
            results.append(_scored(level, length))
    if not results:
        results = [spark.createDataFrame([], "lang string, phrase string, a long, l long, r long, n long, score long")]
    found = results[0]
    for more in results[1:]:
        found = found.unionByName(more)
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = stage(found, "colloc-found").df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _facts(level: DataFrame) -> dict:
    """Phrases of a level, the places where they begin, and their bytes as a table."""
    size = F.octet_length("phrase") + F.octet_length("last") + F.octet_length("lang") + 96
    row = level.agg(F.count(F.lit(1)).alias("phrases"), F.coalesce(F.sum("f"), F.lit(0)).alias("places"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
    return row.asDict()

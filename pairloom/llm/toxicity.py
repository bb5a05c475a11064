"""Toxicity: a counterfactual-regularised linear classifier."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.hashing import byte_grams
from pairloom.llm.text import whole
from pairloom.scratch import stage

# Groups of terms by language; a term is swapped for the next of its group and for the last, which is neutral.
IDENTITY_TERMS = {
    "en": (
        ("women", "men", "girls", "boys", "people"),
        ("woman", "man", "girl", "boy", "person"),
        ("muslims", "christians", "jews", "hindus", "atheists", "believers"),
        ("muslim", "christian", "jewish", "hindu", "atheist", "religious"),
        ("gay", "lesbian", "bisexual", "straight", "transgender", "single"),
        ("black", "white", "asian", "latino", "african", "local"),
        ("immigrants", "refugees", "foreigners", "natives", "residents"),
        ("disabled", "blind", "deaf", "old", "young", "tired"),
    ),
    "de": (
        ("frauen", "männer", "mädchen", "jungen", "menschen"),
        ("frau", "mann", "person"),
        ("muslime", "christen", "juden", "hindus", "gläubige"),
        ("muslimisch", "christlich", "jüdisch", "religiös"),
        ("schwul", "lesbisch", "bisexuell", "ledig"),
        ("ausländer", "flüchtlinge", "einwanderer", "bewohner"),
        ("behindert", "blind", "taub", "müde"),
    ),
    "fr": (
        ("femmes", "hommes", "filles", "garçons", "gens"),
        ("femme", "homme", "fille", "garçon", "personne"),
        ("musulmans", "chrétiens", "juifs", "hindous", "croyants"),
        ("musulman", "chrétien", "juif", "hindou", "croyant"),
        ("gay", "lesbienne", "bisexuel", "célibataire"),
        ("étrangers", "réfugiés", "immigrés", "habitants"),
        ("handicapé", "aveugle", "sourd", "fatigué"),
    ),
    "es": (
        ("mujeres", "hombres", "chicas", "chicos", "personas"),
        ("mujer", "hombre", "chica", "chico", "persona"),
        ("musulmanes", "cristianos", "judíos", "hindúes", "creyentes"),
        ("musulmán", "cristiano", "judío", "hindú", "creyente"),
        ("gay", "lesbiana", "bisexual", "soltero"),
        ("extranjeros", "refugiados", "inmigrantes", "vecinos"),
        ("discapacitado", "ciego", "sordo", "cansado"),
    ),
}
_SENTENCE = re.compile(r"[^.!?\n]+[.!?\n]*")
GRAM = 5
MOST_TERMS = 10_000
# Grams that a task holds before it sends their counts on.
HELD_GRAMS = 4 << 20


@dataclass
class ToxicityModel:
    """Weights of byte n-grams, by their 64-bit hashes in ascending order. A few hundred kilobytes at most.

    ``texts`` tells how many labelled texts it was fitted to, and ``swapped`` how many swapped sentences
    took part in the counterfactual penalty.
    """

    keys: np.ndarray
    weights: np.ndarray
    bias: float
    texts: int = 0
    swapped: int = 0
    _slots: np.ndarray | None = field(default=None, repr=False, compare=False)

    def _table(self) -> np.ndarray:
        """For each value of the top bits, where its keys may begin; -1 without any."""
        if self._slots is None:
            slots = np.full(1 << 20, -1, np.int32)
            top = (self.keys >> np.uint64(44)).astype(np.int64)
            slots[top[::-1]] = np.arange(len(top))[::-1]
            self._slots = slots
        return self._slots

    def find(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which grams the model knows, and the index of each."""
        hit = np.flatnonzero(self._table()[(grams >> np.uint64(44)).astype(np.int64)] >= 0)
        index = np.minimum(np.searchsorted(self.keys, grams[hit]), len(self.keys) - 1)
        same = self.keys[index] == grams[hit]
        return hit[same], index[same]

    def logits(self, texts: pa.Array) -> np.ndarray:
        """Sum of the weights of the different known grams in each text."""
        out = np.full(len(texts), self.bias)
        if not len(self.keys):
            return out
        seen: dict[int, np.ndarray] = {}
        for first, grams, rows in byte_grams(texts, GRAM):
            hit, index = self.find(grams)
            pairs = np.unique((rows[hit] + first) * len(self.keys) + index)
            if first in seen:  # a long text in pieces
                pairs = np.setdiff1d(pairs, seen[first], assume_unique=True)
                seen[first] = np.concatenate([seen[first], pairs])
            else:
                seen = {first: pairs}
            out += np.bincount(pairs // len(self.keys), self.weights[pairs % len(self.keys)], len(out))
        return out

    def scores(self, texts: pa.Array) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.logits(texts), -500, 500)))

    def score(self, text: Column) -> Column:
        """Probability of the label for whole texts, as a column."""
        model = ToxicityModel(self.keys, self.weights, self.bias)

        @F.arrow_udf("double")
        def probability(texts: pa.Array) -> pa.Array:
            return pa.array(model.scores(texts))

        return probability(whole(text))


    def known(self, texts: pa.Array) -> list[np.ndarray]:
        """Indexes of the different known grams of each text."""
        out = [np.empty(0, np.int64)] * len(texts)
        for first, grams, rows in byte_grams(texts, GRAM):
            hit, index = self.find(grams) if len(self.keys) else (rows[:0], rows[:0])
            pairs = np.unique(rows[hit] * max(1, len(self.keys)) + index)
            ends = np.searchsorted(pairs, (np.arange(rows[-1] + 2) if len(rows) else np.arange(1)) * max(1, len(self.keys)))
            for k in range(len(ends) - 1):
                # A long text comes in several pieces.
                out[first + k] = np.union1d(out[first + k], pairs[ends[k] : ends[k + 1]] - k * len(self.keys)).astype(np.int64)
        return out


class Swaps:
    """Swapped sentences of a text: in each sentence, the terms of one group at a time."""

    def __init__(self, groups: Sequence[Sequence[str]]):
        self.following: dict[str, tuple[int, str, str]] = {}
        for number, group in enumerate(groups):
            for k, term in enumerate(group[:-1]):
                self.following.setdefault(term.lower(), (number, group[(k + 1) % (len(group) - 1)], group[-1]))
        # Longer terms first, so that a term that begins with another is found whole.
        terms = sorted(self.following, key=lambda term: (-len(term), term))
        self.pattern = re.compile(rf"(?<!\w)(?:{'|'.join(map(re.escape, terms))})(?!\w)", re.IGNORECASE) if terms else None

    def of(self, text: str) -> Iterator[tuple[str, str]]:
        """Each sentence with a term and the same sentence swapped, for the next terms of a group and for its neutral one."""
        if self.pattern is None or not self.pattern.search(text):
            return
        for sentence in _SENTENCE.findall(text):
            # Case folding may find a letter that has another small form.
            known = {self.following[m.lower()][0] for m in self.pattern.findall(sentence) if m.lower() in self.following}
            for group in sorted(known):
                for by in (1, 2):

                    def other(m: re.Match, group: int = group, by: int = by) -> str:
                        entry = self.following.get(m[0].lower())
                        return entry[by] if entry and entry[0] == group else m[0]

                    twin = self.pattern.sub(other, sentence)
                    if twin != sentence:
                        yield sentence, twin


def all_groups(identity_terms: Mapping[str, Sequence[Sequence[str]]] | DataFrame | None) -> list[tuple[str, ...]]:
    """Groups of terms from a mapping by language or from a table ``(lang, grp, place, term)``, whose last place is neutral."""
    if identity_terms is None:
        return []
    if isinstance(identity_terms, DataFrame):
        rows = identity_terms.select("lang", "grp", "place", "term").limit(MOST_TERMS + 1).collect()
        if len(rows) > MOST_TERMS:
            raise ValueError(f"more than {MOST_TERMS} identity terms")
        held: dict[tuple, list] = {}
        for row in sorted(rows, key=lambda r: (str(r["lang"]), str(r["grp"]), r["place"])):
            held.setdefault((row["lang"], row["grp"]), []).append(row["term"])
        return [tuple(group) for group in held.values() if len(group) > 1]
    return [tuple(group) for groups in identity_terms.values() for group in groups]


def _gram_counts(rows: DataFrame) -> DataFrame:
    """``(gram, a, b)``: how many texts of label 1 and 0 hold each gram, summed on the executors."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {0: [], 1: []}

        def out() -> Iterator[pa.RecordBatch]:
            for label, parts in held.items():
                grams, n = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.empty(0, np.uint64), np.empty(0, np.int64))
                none = np.zeros(len(n), np.int64)
                arrays = [pa.array(grams.view(np.int64)), pa.array(n if label else none), pa.array(none if label else n)]
                yield pa.RecordBatch.from_arrays(arrays, names=["gram", "a", "b"])
                parts.clear()

        for batch in batches:
            labels, seen = batch.column("label").to_pylist(), {}
            for first, grams, rows in byte_grams(batch.column("text"), GRAM):
                ends = np.searchsorted(rows, np.arange(rows[-1] + 2)) if len(rows) else [0]
                for k in range(len(ends) - 1):
                    own = np.unique(grams[ends[k] : ends[k + 1]])
                    if first + k in seen:  # a long text in pieces counts once
                        own = np.setdiff1d(own, seen[first + k], assume_unique=True)
                        seen[first + k] = np.concatenate([seen[first + k], own])
                    elif len(ends) == 2:
                        seen = {first: own}
                    held[labels[first + k]].append(own)
                if sum(len(p) for parts in held.values() for p in parts) > HELD_GRAMS:
                    yield from out()
        yield from out()

    return rows.mapInArrow(count, "gram long, a long, b long").groupBy("gram").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))


def _chosen(counts: DataFrame, n1: int, n0: int, most: int) -> np.ndarray:
    """Grams that tell the labels apart: those with a clear difference in log odds, at least 256 and at most ``most``.

    Grams of one text only tell nothing. All are weighed on the executors; the driver gets the chosen ones.
    """
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    odds = F.ln(a / (F.lit(n1 + 1.0) - a)) - F.ln(b / (F.lit(n0 + 1.0) - b))
    clear = F.abs(odds) / F.sqrt(1 / a + 1 / b)
    best = counts.filter("a + b > 1").select("gram", clear.alias("clear")).orderBy(F.col("clear").desc(), "gram").limit(most).toPandas()
    kept = best["gram"].to_numpy(np.int64)[: max(256, int((best["clear"] >= 4).sum()))]
    return np.sort(kept.view(np.uint64))


def _features(rows: DataFrame, keys: np.ndarray, groups: Sequence[Sequence[str]]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Labels and known grams of all texts, and for each swapped sentence the grams that the swap adds (``index + 1``) or takes away (negative).

    Texts stay on the executors; the driver gets numbers of grams.
    """
    shared = rows.sparkSession.sparkContext.broadcast(ToxicityModel(keys, np.zeros(len(keys)), 0.0))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, swaps = shared.value, Swaps(groups)
        for batch in batches:
            texts = batch.column("text")
            found = list(zip(batch.column("k").to_pylist(), batch.column("label").to_pylist(), model.known(texts), strict=True))
            for k, text in zip(batch.column("k").to_pylist(), texts, strict=True):
                pairs = list(swaps.of(text.as_py()))
                for at in range(0, len(pairs), 256):
                    part = pairs[at : at + 256]
                    before, after = (model.known(pa.array([p[side] for p in part], pa.string())) for side in (0, 1))
                    for x, y in zip(before, after, strict=True):
                        change = np.concatenate([np.setdiff1d(y, x) + 1, -1 - np.setdiff1d(x, y)])
                        found.append((k, -1, change))
            lists = [f[2].astype(np.int32) for f in found]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
            grams = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(lists) if lists else np.empty(0, np.int32)))
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int32()), grams], names=["k", "label", "grams"])

    table = rows.mapInArrow(find, "k long, label int, grams array<int>").toArrow()
    lists = table.column("grams").combine_chunks()
    flat, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
    label, k = table.column("label").to_numpy(), table.column("k").to_numpy()
    grams = [flat[ends[i] : ends[i + 1]] for i in range(len(label))]
    # The order of rows must not depend on which task was faster.
    order = np.lexsort((label, k))
    texts, pairs = [i for i in order if label[i] >= 0], [i for i in order if label[i] < 0]
    pairs.sort(key=lambda i: (k[i], grams[i].tolist()))
    return label[texts], [grams[i] for i in texts], [grams[i] for i in pairs]


def solve(
    labels: np.ndarray,
    grams: list[np.ndarray],
    changes: list[np.ndarray],
    keys: np.ndarray,
    weight: np.ndarray,
    *,
    fairness: float = 1.0,
    ridge: float = 1e-4,
    passes: int = 300,
) -> ToxicityModel:
    """Logistic regression on the presence of known grams, with a counterfactual penalty.

    ``fairness`` times the mean squared change of the logit by a swap of identity terms in a sentence is
    added to the loss, so a group's mention alone moves the score little, however often it
    stands in toxic examples. Without both labels the model is a constant.
    """
    y = np.asarray(labels, float)
    share = float((weight * y).sum() / weight.sum()) if len(y) and weight.sum() else 0.0
    if not 0 < share < 1:
        return ToxicityModel(np.empty(0, np.uint64), np.empty(0), float(np.log((share + 1e-6) / (1 - share + 1e-6))), len(y), len(changes))

    def cells(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        flat = np.concatenate(lists) if lists else np.empty(0, np.int32)
        return np.repeat(np.arange(len(lists), dtype=np.int32), [len(x) for x in lists]), flat

    rows, columns = cells(grams)
    change_rows, signed = cells(changes)
    change_columns, sign = np.abs(signed) - 1, np.sign(signed).astype(float)
    w, bias = np.zeros(len(keys)), float(np.log(share / (1 - share)))
    speed, bias_speed, step = np.full(len(keys), 1e-8), 1e-8, 0.3
    scale = weight / weight.sum()
    for _ in range(passes):
        z = np.bincount(rows, w[columns], len(y)) + bias
        slope = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y) * scale
        gradient = ridge * w + np.bincount(columns, slope[rows], len(keys))
        if len(changes):
            change = np.bincount(change_rows, sign * w[change_columns], len(changes))
            push = 2 * fairness * change / len(changes)
            gradient += np.bincount(change_columns, sign * push[change_rows], len(keys))
        speed += gradient**2
        bias_speed += slope.sum() ** 2
        w -= step * gradient / np.sqrt(speed)
        bias -= step * slope.sum() / np.sqrt(bias_speed)
    return ToxicityModel(keys, w, bias, len(y), len(changes))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from. A null id counts as an empty text."""
    return F.crc32(whole(doc_id).cast("binary")) % 5 == 0


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample: int = 2500,
    sample_bytes: int = 25_000_000,
    identity_terms: Mapping[str, Sequence[Sequence[str]]] | DataFrame | None = IDENTITY_TERMS,
    most_grams: int = 8192,
    seed: int = 11,
    **options,
) -> ToxicityModel:
    """Train on at most ``sample`` labelled texts of either label, as many as hold about ``sample_bytes`` bytes.

    The sample is bounded whatever the size of the tables: rows with the smallest seeded hash of
    their id, long or short, each with its whole text, up to and with the one that reaches
    ``sample_bytes``. Rows of either label weigh as much as there are of them. Held-out rows, null
    labels and labels without a document are left out; of labels that repeat an id, the largest
    counts.

    In each sentence of these texts the identity terms of a group are swapped for others, and score changes
    are penalised, see :class:`Swaps` and :func:`solve`. ``identity_terms`` are groups by language or a
    table, see :func:`all_groups`. Grams are counted, weighed and looked up on the executors. The driver
    holds numbers of known grams, at most ``most_grams`` for a text and two lists for each sentence with a
    group's term, but no text.
    """
    spark = docs.sparkSession
    known = labels.select(F.col(id_col).alias("label_id"), F.col(label_col).cast("int").alias("label"))
    known = known.filter(F.col("label").isin(0, 1) & ~held_out(F.col("label_id")))
    known = known.groupBy("label_id").agg(F.max("label").alias("label"))
    counts = {row["label"]: row["n"] for row in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    # Twice the sample by hash, as some have no document.
    draw = F.xxhash64(F.lit(seed), "label_id")
    drawn = [known.filter(F.col("label") == y).orderBy(draw, "label_id").limit(2 * sample) for y in (0, 1)]
    # Bounded by the sample.
    drawn = F.broadcast(drawn[0].unionByName(drawn[1]))
    texts = docs.select(F.col(id_col).alias("id"), whole(F.col(text_col)).alias("text"))
    texts = texts.join(drawn, F.col("id") == F.col("label_id")).select("label_id", "label", "text")
    texts = stage(texts.withColumn("row", F.monotonically_increasing_id()), "toxicity-drawn").df
    # Only numbers take part in the order; texts that are not taken stay where they are.
    order = ["draw", "label_id", "tie"]
    narrow = texts.select("row", "label", "label_id", draw.alias("draw"), F.xxhash64("text").alias("tie"), F.octet_length("text").alias("bytes"))
    parts = [narrow.filter(F.col("label") == y).orderBy(*order).limit(sample) for y in (0, 1)]
    taken = parts[0].unionByName(parts[1]).toPandas().sort_values(["label", *order])
    before = taken.groupby("label")["bytes"].cumsum() - taken["bytes"]
    taken = taken[before < sample_bytes].reset_index(drop=True)
    # An Arrow table goes to the executors as it is; a list would take a Python process there.
    wanted = spark.createDataFrame(pa.table({"row": pa.array(taken["row"], pa.int64()), "k": pa.array(range(len(taken)), pa.int32())}))
    rows = stage(texts.join(F.broadcast(wanted), "row").select("k", "label", "text"), "toxicity-sample").df
    n1, n0 = (int((taken["label"] == y).sum()) for y in (1, 0))
    keys = _chosen(_gram_counts(rows), n1, n0, most_grams) if n1 and n0 else np.empty(0, np.uint64)
    y, grams, changes = _features(rows, keys, all_groups(identity_terms))
    each = np.array([counts.get(k, 0) / max(1, n) for k, n in ((0, n0), (1, n1))])
    return solve(y, grams, changes, keys, each[y] if len(y) else np.empty(0), **options)


def score_toxicity(docs: DataFrame, model: ToxicityModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, held_out, score, predicted)``, a row for every row of ``docs``.

    Whole texts are scored, in pieces, and nothing but the text is an input. A null text counts as
    empty; an empty text gets the score of a text without any known gram. Rows that repeat an id
    are scored one by one. Other columns are not read. An empty table gives no rows.
    """
    score = model.score(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), score.alias("score"))
    return rows.select(
        F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )

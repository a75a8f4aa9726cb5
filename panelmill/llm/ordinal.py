"""Ordinal quality classifier: cumulative-link regression over hashed text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmill.llm.batches import slices
from panelmill.llm.shared import map_batches, ship_code, stored

#: Buckets that features are hashed into.
DIMENSIONS = 1 << 20
#: Labelled documents that the model is fitted on, at most.
FIT_ROWS = 16_000
#: Features seen in fewer of these get no weight.
LEAST_SEEN = 5
#: So do features whose texts have grades as chance would deal them: a chi-square below this.
LEAST_STRANGE = 20.0
#: A word also counts by its first letters, so that inflected forms share a weight.
BEGINNINGS = (4, 5)
#: Bytes of texts whose features are worked out at a time; a longer text is worked out alone.
TEXT_BYTES = 1 << 20
_EDGES = np.array([0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.7, 0.9])
_SHARES = ("distinct", "upper", "marked", "bare", "digits")


def _bucket(feature: str) -> int:
    return xxhash.xxh64_intdigest(feature.encode("utf-8", "surrogatepass"), 7) % DIMENSIONS


def _traits(token: str) -> tuple[int, int, int, bool, bool, bool, bool]:
    """Buckets of the token's letters in lower case and of their beginnings, and what its shape counts for."""
    core = token.strip(".,;:!?\"'()[]{}*#$%&|<>-_/\\").lower()
    marked = any(c in "*#$%&|<>!" for c in token)
    return (
        _bucket("w:" + core) if core else -1, *(_bucket("p:" + core[:n]) if len(core) >= n else -1 for n in BEGINNINGS),
        len(token) > 1 and token.upper() == token and token.lower() != token,
        marked, not core, any(c.isdigit() for c in token),
    )


_SHARE_BUCKETS = {
    (name, step): _bucket(f"s:{name}:{step}") for name in _SHARES for step in range(len(_EDGES) + 1)
}


class Features:
    """Feature buckets of texts: the distinct words, and steps of five shares of the words.

    A word's traits are worked out once and kept as a row of a numeric table while
    there is room; a full table is emptied. So a worker's memory has a bound, however many words there are.
    """

    def __init__(self, most_kept: int = 100_000):
        self.place: dict[str, int] = {}
        self.table = np.zeros((most_kept, 1 + len(BEGINNINGS) + len(_SHARES) - 1), np.int32)

    def _traits(self, tokens: list[str]) -> np.ndarray:
        new = [t for t in tokens if t not in self.place]
        if len(self.place) + len(new) > len(self.table):
            self.place.clear()
            new = tokens
            if len(new) > len(self.table):  # one text may hold more words than the table
                return np.array([_traits(t) for t in new], np.int32)
        if new:
            begin = len(self.place)
            self.table[begin:begin + len(new)] = [_traits(t) for t in new]
            self.place.update(zip(new, range(begin, begin + len(new)), strict=True))
        return self.table[np.fromiter(map(self.place.__getitem__, tokens), np.int64, len(tokens))]

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(text number, bucket) pairs, each once, by text."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        words = pc.ascii_split_whitespace(texts)
        lengths = pc.list_value_length(words).to_numpy(zero_copy_only=False)
        coded = words.flatten().dictionary_encode()
        tokens = coded.dictionary.to_pylist()
        n, wide = len(texts), np.int64(len(tokens) or 1)
        forms = 1 + len(BEGINNINGS)
        traits = self._traits(tokens) if tokens else np.zeros((0, self.table.shape[1]), np.int32)
        token = coded.indices.to_numpy(zero_copy_only=False)
        doc = np.repeat(np.arange(n), lengths)
        if "" in tokens:  # ascii_split_whitespace gives empty tokens at the ends of a text
            full = token != tokens.index("")
            doc, token = doc[full], token[full]
        pair_doc, pair_token = np.divmod(np.unique(doc * wide + token), wide)
        some = np.maximum(np.bincount(doc, minlength=n), 1)
        shares = [np.bincount(pair_doc, minlength=n) / some]
        for flag in traits[:, forms:].T:
            shares.append(np.bincount(doc, weights=flag[token], minlength=n) / some)
        found = []
        for form in traits[:, :forms].T:
            bucket = form[pair_token]
            found.append((pair_doc * DIMENSIONS + bucket)[bucket >= 0])
        for name, share in zip(_SHARES, shares, strict=True):
            which = np.array([_SHARE_BUCKETS[name, s] for s in range(len(_EDGES) + 1)], np.int64)
            found.append(np.arange(n) * DIMENSIONS + which[np.searchsorted(_EDGES, share, "right")])
        every = np.unique(np.concatenate(found))
        return every // DIMENSIONS, every % DIMENSIONS


@dataclass
class OrdinalModel:
    """Weights by bucket, shared by all grades, and ascending thresholds between the grades."""

    buckets: np.ndarray  # ascending
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, doc: np.ndarray, bucket: np.ndarray, n: int) -> np.ndarray:
        """(n, grades - 1): the probability of each grade but the lowest or a higher one."""
        at = np.minimum(np.searchsorted(self.buckets, bucket), max(0, len(self.buckets) - 1))
        known = self.buckets[at] == bucket if len(self.buckets) else np.zeros(len(bucket), bool)
        score = np.bincount(doc[known], weights=self.weights[at[known]], minlength=n)
        return _sigmoid(score[:, None] - self.thresholds[None, :])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def fit_ordinal(
    doc: np.ndarray, bucket: np.ndarray, grade: np.ndarray, grades: int,
    rounds: int = 250, rate: float = 0.08, decay: float = 2e-4,
) -> OrdinalModel:
    """Maximum likelihood of P(grade > j) = sigmoid(score - threshold j), by Adam on all rows and all buckets given.

    The thresholds are a first one and positive steps, so they stay in order.
    Classes are weighted towards each other by the square root of their sizes.
    """
    buckets, at = np.unique(bucket, return_inverse=True)
    n = len(grade)
    size = np.bincount(grade, minlength=grades)
    weight = (1 / np.sqrt(np.maximum(size, 1)))[grade]
    weight = weight * n / max(weight.sum(), 1e-12)
    params = np.zeros(len(buckets) + grades - 1)
    first, moment, square = len(buckets), np.zeros_like(params), np.zeros_like(params)
    params[first] = -1.0
    for t in range(1, rounds + 1 if n else 1):
        w, cuts = params[:first], params[first:]
        steps = np.exp(cuts[1:])
        thresholds = np.concatenate([cuts[:1], cuts[0] + np.cumsum(steps)])
        score = np.bincount(doc, weights=w[at], minlength=n)
        edges = np.concatenate([[np.inf], -thresholds, [-np.inf]])  # score + edge: from certain to never
        upper, lower = _sigmoid(score + edges[grade]), _sigmoid(score + edges[grade + 1])
        prob = np.maximum(upper - lower, 1e-12)
        d_upper, d_lower = upper * (1 - upper) / prob * weight, lower * (1 - lower) / prob * weight
        slope = d_upper - d_lower  # of the likelihood, by score
        by_edge = np.bincount(grade, weights=d_upper, minlength=grades + 1) - np.bincount(grade + 1, weights=d_lower, minlength=grades + 1)
        by_threshold = -by_edge[1:grades]
        g = np.empty_like(params)
        g[:first] = np.bincount(at, weights=slope[doc], minlength=first) / n - decay * w
        g[first] = by_threshold.sum() / n
        g[first + 1:] = np.cumsum(by_threshold[::-1])[::-1][1:] * steps / n
        moment = 0.9 * moment + 0.1 * g
        square = 0.999 * square + 0.001 * g * g
        params += rate * (moment / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.999**t)) + 1e-8)
    cuts = params[first:]
    return OrdinalModel(buckets, params[:first], np.concatenate([cuts[:1], cuts[0] + np.cumsum(np.exp(cuts[1:]))]))


#: Grades of a rated document: 0 of low quality, 1 toxic, 2 good.
GRADES = 3


def grade(quality: Column, toxic: Column) -> Column:
    """The grade of a label row; null, and so not used, if the quality is null."""
    return F.when(quality == 0, 0).when((quality == 1) & (F.coalesce(toxic, F.lit(0)) == 1), 1).when(quality == 1, 2)


def _telling(rows: DataFrame, sizes: dict[int, int]) -> np.ndarray:
    """Ascending buckets that are frequent enough and whose texts do not have grades as by chance."""
    total = sum(sizes.values())
    by = {g: F.sum(F.when(F.col("grade") == g, 1).otherwise(0)).alias(f"n{g}") for g in sizes}
    if not by:
        return np.zeros(0, np.int32)
    counts = rows.select("grade", F.explode("buckets").alias("bucket")).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("seen"), *by.values()
    )
    strange = F.lit(0.0)
    for g, n in sizes.items():
        chance = F.col("seen") * (n / total)
        strange = strange + (F.col(f"n{g}") - chance) * (F.col(f"n{g}") - chance) / chance
    kept = counts.where((F.col("seen") >= LEAST_SEEN) & (strange >= LEAST_STRANGE)).select("bucket").toArrow()
    return np.sort(kept.column("bucket").to_numpy())


def train(
    docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, key: str = "doc_id", text: str = "text"
) -> OrdinalModel:
    """Fit on at most ``fit_rows`` labelled documents, those with the smallest hashes of their keys.

    Of several rows with one key the smallest text counts, nulls last. The
    chosen keys and grades are broadcast (bounded by ``fit_rows``), tasks work
    out the features and count them by grade, and only features that tell grades
    apart come to the driver, which fits their weights.
    """
    rated = labels.select(labels[key].alias("key"), grade(labels["quality"], labels["toxic"]).alias("grade"))
    rated = rated.where("key IS NOT NULL AND grade IS NOT NULL").groupBy("key").agg(F.min("grade").alias("grade"))
    chosen = rated.orderBy(F.xxhash64("key"), "key").limit(fit_rows)
    rows = docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text"))
    rows = rows.join(F.broadcast(chosen), "key").groupBy("key", "grade").agg(F.min("text").alias("text")).select("grade", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for part in slices(batches, "text", TEXT_BYTES):
            doc, bucket = features.of(part.column("text"))
            ends = np.searchsorted(doc, np.arange(len(part) + 1))
            yield pa.RecordBatch.from_arrays(
                [part.column("grade"), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(bucket.astype(np.int32)))],
                names=["grade", "buckets"],
            )

    rows = stored(map_batches(rows, run, "grade int, buckets array<int>"), "rated")
    sizes = {r["grade"]: r["n"] for r in rows.groupBy("grade").agg(F.count(F.lit(1)).alias("n")).collect()}
    known = _telling(rows, sizes)

    def only_known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("buckets")
            flat = lists.flatten().to_numpy()
            stays = np.isin(flat, known)
            ends = np.concatenate([[0], np.cumsum(stays)])[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
            few = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat[stays]))
            yield pa.RecordBatch.from_arrays([batch.column("grade"), few], names=["grade", "buckets"])

    got = map_batches(rows, only_known, "grade int, buckets array<int>").toArrow()
    lists = got.column("buckets").combine_chunks()
    doc = np.repeat(np.arange(len(got), dtype=np.int32), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    return fit_ordinal(doc, lists.flatten().to_numpy(), got.column("grade").to_numpy().astype(np.int64), GRADES)


def _verdict(model: OrdinalModel, keep: float):
    """A function of texts: only they go to the workers and only figures come back, the rows stay in Spark."""

    @F.arrow_udf("expected_grade double, tail_probability double, kept boolean")
    def verdict(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        features = Features()
        for batch in texts:
            parts = [np.zeros((0, len(model.thresholds)))]
            for part in slices([pa.RecordBatch.from_arrays([batch], ["text"])], "text", TEXT_BYTES):
                doc, bucket = features.of(part.column("text"))
                parts.append(model.tails(doc, bucket, len(part)))
            tails = np.concatenate(parts)
            figures = [tails.sum(axis=1), tails[:, -1], tails[:, -1] >= keep]
            yield pa.StructArray.from_arrays([pa.array(x) for x in figures], ["expected_grade", "tail_probability", "kept"])

    return verdict


def score(
    docs: DataFrame, model: OrdinalModel, text: str = "text", keep: float = 0.5, columns: list[str] | None = None
) -> DataFrame:
    """The ``columns`` of docs (all by default) as a struct ``row``, with expected_grade, tail_probability (of the best grade) and kept."""

    ship_code(docs.sparkSession)
    row = F.struct(*[docs[c] for c in columns or docs.columns]).alias("row")
    return docs.select(row, _verdict(model, keep)(docs[text].cast("string")).alias("found")).select("row", "found.*")


def classify(
    docs: DataFrame, labels: DataFrame, keep: float = 0.5, fit_rows: int = FIT_ROWS, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: key, expected_grade (0 to 2), tail_probability (of grade 2) and kept.

    The model is fitted by ``train``; a document is kept if grade 2 has at least
    probability ``keep``. Null and empty texts have no words and are scored by
    their shares alone. Repeated rows and null keys are scored each. Labels with
    a null key or quality are not used; of several for one key the lowest
    grade counts, and of several documents with it the smallest text. Without
    any label all documents get the same score. Other columns are not read. An empty table gives no rows. Scoring is one pass
    without a shuffle.
    """
    model = train(docs, labels, fit_rows, key, text)
    scored = score(docs, model, text, keep, [key])
    return scored.select(F.col("row")[key].alias(key), "expected_grade", "tail_probability", "kept")


def keep_best(
    docs: DataFrame, rated: DataFrame, labels: DataFrame, keep: float = 0.5, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of ``docs``, with all their columns, that a model fitted on ``rated`` and ``labels`` keeps."""
    model = train(rated, labels, key=key, text=text)
    ship_code(docs.sparkSession)
    return docs.where(_verdict(model, keep)(docs[text].cast("string"))["kept"])

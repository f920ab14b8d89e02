"""A convolutional text classifier over hashed word embeddings, trained in numpy.

A word's embedding is the sum of four rows of one table, chosen by two hashes of the word and one
of its first four and six bytes, so that two words share an embedding only if all agree and new
words with a known beginning are not lost. Filters of width one, two and three slide over the
words; the largest value of each filter in the whole text feeds a logistic layer.

It is trained on all labelled rows but a part that is kept back. The rows are dealt to shards, and
in each epoch every shard trains the network that all begin with on its own rows; what the shards
changed is averaged. On all rows kept back the threshold of each language is set to where the F1
score is best, and scores are shifted so that this threshold becomes `CUT`. The language of a text
is guessed from the text by compression.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import BROADCAST_ROWS, give_back, quoted, ship, written
from sluice.llm.hashing import BYTES, mixed, running, stretches, words
from sluice.llm.langid import Languages

#: Labelled rows, and characters of them, of a shard, about.
SHARD_ROWS, SHARD_CHARS = 8192, 40_000_000
#: Rows of the embedding table, and numbers in each.
BUCKETS, DIMS = 1 << 18, 8
WIDTHS, FILTERS = (1, 2, 3), 8
EPOCHS, BATCH_TEXTS, RATE = 6, 32, 0.004
#: One labelled text in so many sets thresholds instead of weights.
KEPT_BACK = 5
#: Texts of a label that a language needs for a threshold of its own.
LEAST = 8
#: The score at which a text counts as toxic.
CUT = 0.7
#: Words convolved at once.
STEP = 8192
#: Words of a shard whose vocabulary is made at once.
CHUNK = 1 << 20
#: Parts of the table that are added up apart.
PARTS = 256
#: Ranges of logits that are ranked apart.
RANGES = 64

_FEATURES = 4
_SEPARATORS = np.array([not (chr(i).isalnum() or i >= 128) for i in range(256)])
_SALTS = mixed(np.arange(1, _FEATURES + 1, dtype=np.uint64))
_SHIFT = np.uint64(64 - int(math.log2(BUCKETS)))


def features(text: str | None) -> np.ndarray:
    """For each word of a text the four rows of the table."""
    data = np.frombuffer((text or "").lower().encode(), np.uint8)
    parts, start = [], 0
    while start < len(data):
        stop = min(start + 250_000, len(data))
        while stop < len(data) and not _SEPARATORS[data[stop]]:
            stop += 1
        piece = data[start:stop]
        begin, end = words(piece, _SEPARATORS)
        sums = running(piece, BYTES)
        whole = stretches(sums, begin, end)
        hashes = (
            whole,
            whole,
            stretches(sums, begin, np.minimum(end, begin + 4)),
            stretches(sums, begin, np.minimum(end, begin + 6)),
        )
        parts.append(np.stack([(mixed(h ^ s) >> _SHIFT).astype(np.int32) for h, s in zip(hashes, _SALTS)], 1))
        start = stop
    return np.concatenate(parts) if parts else np.zeros((0, _FEATURES), np.int32)


class Network:
    def __init__(self, seed: int = 0) -> None:
        random = np.random.default_rng(seed)
        n = len(WIDTHS) * FILTERS
        self.table = random.normal(0, 0.02, (BUCKETS, DIMS)).astype(np.float32)
        self.filters = [random.normal(0, 0.3, (w, DIMS, FILTERS)).astype(np.float32) for w in WIDTHS]
        for kernel in self.filters:
            kernel[:, 0] = np.abs(kernel[:, 0])  # the first number of an embedding starts as evidence
        self.bias = np.zeros(n, np.float32)
        self.out = np.abs(random.normal(0, 0.3, n)).astype(np.float32)
        self.out_bias = np.zeros(1, np.float32)

    def sides(self, rows: np.ndarray) -> np.ndarray:
        """What each word adds to the filters: as their first word, as the second of those that have one, ..."""
        embedded = self.table.take(rows[:, 0], 0)
        for k in range(1, _FEATURES):
            embedded += self.table.take(rows[:, k], 0)
        parts = [kernel[k] for k in range(WIDTHS[-1]) for kernel in self.filters if len(kernel) > k]
        return embedded @ np.concatenate(parts, 1)

    def _responses(self, side: np.ndarray, n: int) -> np.ndarray:
        """Filter values at the first n words of `side`; beyond its last word all is zero."""
        at = len(WIDTHS) * FILTERS
        out = side[:n, :at] + self.bias
        for k in range(1, WIDTHS[-1]):
            size = sum(w > k for w in WIDTHS) * FILTERS
            part = side[k : k + n, at : at + size]
            out[: len(part), -size:] += part
            at += size
        return out

    def _steps(self, side: Callable[[slice], np.ndarray], n: int) -> Iterator[tuple[int, np.ndarray]]:
        for start in range(0, n, STEP):
            yield start, self._responses(side(slice(start, start + STEP + WIDTHS[-1] - 1)), min(STEP, n - start))

    def pooled(self, rows: np.ndarray) -> np.ndarray:
        """The largest value of each filter in a text, at least 0."""
        best = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        for _, values in self._steps(lambda s: self.sides(rows[s]), len(rows)):
            np.maximum(best, values.max(0), out=best)
        return best

    def pooled_at(self, rows: np.ndarray, index: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The same, and the word where it is, -1 for none.

        With `index` the first are the `sides` of a vocabulary, and the words are numbers in it.
        """
        n = len(WIDTHS) * FILTERS
        best, place = np.zeros(n, np.float32), np.full(n, -1)
        if index is None:
            steps = self._steps(lambda s: self.sides(rows[s]), len(rows))
        else:
            steps = self._steps(lambda s: rows[index[s]], len(index))
        for start, values in steps:
            at = values.argmax(0)
            top = values[at, np.arange(n)]
            better = top > best
            best[better], place[better] = top[better], start + at[better]
        return best, place

    def start_from(self, seen: np.ndarray, toxic: np.ndarray, share: float) -> None:
        """Set the first number of each row to how much oftener than chance its texts are toxic."""
        expected = seen * share
        self.table[:, 0] = np.clip((toxic - expected) / np.sqrt(expected + 1), -5, 5) / 5

    def logit(self, rows: np.ndarray) -> float:
        return float(self.pooled(rows) @ self.out + self.out_bias[0])

    def dense(self) -> list[np.ndarray]:
        return [*self.filters, self.bias, self.out, self.out_bias]

    def fit(self, texts: Texts, share: float, seed: int = 0) -> np.ndarray:
        """One epoch of Adam on the weighted log loss, and how often each row of the table was changed.

        `share` is that of toxic texts among all; only the rows of the table that fired are touched.
        """
        random = np.random.default_rng(seed)
        labels = texts.labels
        weights = np.where(labels == 1, 0.5 / share, 0.5 / max(1e-6, 1 - share))
        dense = self.dense()
        first, second = [np.zeros_like(p) for p in dense], [np.zeros_like(p) for p in dense]
        first_of_table, second_of_table = np.zeros_like(self.table), np.zeros_like(self.table)
        changed = np.zeros(BUCKETS, np.float32)
        order = random.permutation(len(labels))
        for step, start in enumerate(range(0, len(order), BATCH_TEXTS), 1):
            chosen = order[start : start + BATCH_TEXTS]
            parts = [texts.index[texts.starts[i] : texts.starts[i + 1]] for i in chosen]
            known, words = np.unique(np.concatenate(parts), return_inverse=True)
            known = texts.vocabulary[known]
            sides = self.sides(known)
            ends = np.cumsum([len(p) for p in parts])
            begins = ends - [len(p) for p in parts]
            found = [self.pooled_at(sides, words[a:b]) for a, b in zip(begins, ends)]
            best, place = np.stack([f[0] for f in found]), np.stack([f[1] for f in found])
            logits = np.clip(best @ self.out + self.out_bias[0], -30, 30)
            errors = ((1 / (1 + np.exp(-logits)) - labels[chosen]) * weights[chosen] / len(chosen)).astype(np.float32)
            back = errors[:, None] * self.out * (best > 0)
            grads = [np.zeros_like(p) for p in self.filters]
            grads += [back.sum(0), errors @ best, errors.sum(keepdims=True)]
            touched: list[np.ndarray] = []
            pulls: list[np.ndarray] = []
            for w, kernel in enumerate(self.filters):
                mine = slice(w * FILTERS, (w + 1) * FILTERS)
                for k in range(len(kernel)):
                    at = place[:, mine] + k + begins[:, None]
                    text, f = np.nonzero((place[:, mine] >= 0) & (at < ends[:, None]))
                    if not len(f):
                        continue
                    rows = known[words[at[text, f]]]
                    pull = back[:, mine][text, f][:, None]
                    np.add.at(grads[w][k].T, f, self.table[rows].sum(1) * pull)
                    touched.append(rows.ravel())
                    pulls.append(np.repeat(kernel[k][:, f].T * pull, _FEATURES, 0))
            scale = math.sqrt(1 - 0.999**step) / (1 - 0.9**step) * RATE
            for p, g, m, v in zip(dense, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= scale * m / (np.sqrt(v) + 1e-8)
            if touched:
                rows, where = np.unique(np.concatenate(touched), return_inverse=True)
                g = np.zeros((len(rows), DIMS), np.float32)
                np.add.at(g, where, np.concatenate(pulls))
                m = first_of_table[rows] = 0.9 * first_of_table[rows] + 0.1 * g
                v = second_of_table[rows] = 0.999 * second_of_table[rows] + 0.001 * g * g
                self.table[rows] -= scale * m / (np.sqrt(v) + 1e-8)
                changed[rows] += 1
        return changed


@dataclass
class Texts:
    """Labelled texts of a shard: their words as numbers of a vocabulary, whose words are `features`."""

    vocabulary: np.ndarray
    index: np.ndarray
    #: Where each text starts in `index`, and the end of the last.
    starts: np.ndarray
    labels: np.ndarray

    @staticmethod
    def of(texts: Iterator[tuple[str, int]]) -> Texts:
        """Texts and labels; the words of about `CHUNK` are held apart at once."""
        vocabularies, indexes, lengths, labels, waiting, size = [], [], [], [], [], 0
        known = 0

        def made() -> None:
            nonlocal known
            vocabulary, index = _distinct(np.concatenate(waiting))
            vocabularies.append(vocabulary)
            indexes.append((index + known).astype(np.int32))
            known += len(vocabulary)
            waiting.clear()

        for text, label in texts:
            waiting.append(features(text))
            lengths.append(len(waiting[-1]))
            labels.append(label)
            size += lengths[-1]
            if size >= CHUNK:
                made()
                size = 0
        if waiting:
            made()
        vocabulary, again = _distinct(np.concatenate(vocabularies))
        index = np.concatenate([again[part].astype(np.int32) for part in indexes])
        return Texts(vocabulary, index, np.cumsum([0, *lengths]), np.array(labels, np.int32))

    def counts(self) -> np.ndarray:
        """For each row of the table the texts that have it, and the toxic ones among them."""
        out = np.zeros((BUCKETS, 2), np.float32)
        for a, b, label in zip(self.starts, self.starts[1:], self.labels):
            own = np.unique(self.vocabulary[np.unique(self.index[a:b])])
            out[own, 0] += 1
            out[own, 1] += label
        return out


def _distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different rows of `features`, and for each row its number among them."""
    three = rows[:, :3].astype(np.int64) @ np.array([1, BUCKETS, BUCKETS**2])
    some = np.unique(three, return_inverse=True)[1]
    _, at, index = np.unique(some * BUCKETS + rows[:, 3], return_index=True, return_inverse=True)
    return rows[at], index


@dataclass
class Classifier:
    network: Network | None
    languages: Languages
    #: Logit at which a text of a language counts as toxic; under None for all others.
    thresholds: dict[str | None, float]

    def score(self, text: str | None) -> float:
        """0 to 1; at least `CUT` from the threshold on. 0 if there was nothing to learn from."""
        if self.network is None:
            return 0.0
        logit = self.network.logit(features(text))
        at = self.thresholds[None]
        if len(self.thresholds) > 1:
            at = self.thresholds.get(self.languages.best(text)[0], at)
        distance = max(-30.0, min(30.0, logit - at))
        return 1 / (1 + (1 - CUT) / CUT * math.exp(-distance))


def best_threshold(logits: np.ndarray, labels: np.ndarray) -> float:
    """The middle of the gap between two neighbouring logits where F1 is largest."""
    order = np.argsort(-logits, kind="stable")
    ranked, hits = logits[order], np.cumsum(labels[order] == 1)
    last = np.append(ranked[1:] < ranked[:-1], True)
    f1 = np.where(last, 2 * hits / (np.arange(1, len(hits) + 1) + max(1, hits[-1])), -1)
    i = int(f1.argmax())
    return float((ranked[i] + ranked[i + 1]) / 2) if i + 1 < len(ranked) else float(ranked[i])


def best_thresholds(judged: DataFrame) -> dict[str | None, float]:
    """`best_threshold` of all rows (name, logit, label), under None, and of each name's own.

    A name needs `LEAST` rows of either label. Equal logits are counted together, and ranges of
    logits are ranked apart, each from where those above it end.
    """
    edges = judged.approxQuantile("logit", [i / RANGES for i in range(1, RANGES)], 0.001)
    above = F.lit(0)
    for edge in sorted(set(edges)):
        above += (F.col("logit") < F.lit(edge)).cast("int")
    both = judged.withColumn("name", F.explode(F.array("name", F.lit(None).cast("string"))))
    counts = both.groupBy("name", "logit").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("hits"))
    counts = written(counts.withColumn("range", above), "logits")
    order = Window.partitionBy("name").orderBy("range")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    totals = counts.groupBy("name", "range").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))
    totals = totals.select(
        F.col("name").alias("of"),
        F.col("range").alias("there"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"),
        F.coalesce(F.sum("hits").over(before), F.lit(0)).alias("hits_before"),
        F.sum("n").over(Window.partitionBy("name")).alias("n_all"),
        F.sum("hits").over(Window.partitionBy("name")).alias("hits_all"),
    )
    same = F.col("name").eqNullSafe(F.col("of"))
    ranked = counts.join(F.broadcast(totals), same & (F.col("range") == F.col("there")))
    down = Window.partitionBy("name", "range").orderBy(F.desc("logit"))
    n = F.col("n_before") + F.sum("n").over(down)
    hits = F.col("hits_before") + F.sum("hits").over(down)
    f1 = 2 * hits / (n + F.greatest(F.lit(1), "hits_all"))
    enough = F.col("name").isNull() | (F.least("hits_all", F.col("n_all") - F.col("hits_all")) >= LEAST)
    best = ranked.filter(enough).select("name", F.struct(f1.alias("f1"), "logit").alias("here"))
    best = best.groupBy("name").agg(F.max("here").alias("here"))
    best = F.broadcast(written(best.select(F.col("name").alias("of"), F.col("here.logit").alias("top")), "best"))
    lower = F.max(F.when(F.col("logit") < F.col("top"), F.col("logit"))).alias("lower")
    return {
        r.of: (r.top + r.lower) / 2 if r.lower is not None else r.top
        for r in counts.join(best, same).groupBy("of", "top").agg(lower).collect()
    }


_SHARD = "shard int, n long, toxic long, vocabulary binary, index binary, starts binary, labels binary"


def _shards(known: DataFrame, n: int) -> DataFrame:
    """One row for each of at most n shards: its rows of `known` (doc, content, label, order, text) as `Texts`."""
    dealt = known.withColumn("shard", F.pmod(F.xxhash64("order", F.lit(1)), F.lit(n)).cast("int"))
    dealt = dealt.select("shard", "order", "doc", "content", "label", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            row
            for batch in batches
            for part in (batch.slice(i, 64) for i in range(0, len(batch), 64))
            for row in zip(*(c.to_pylist() for c in part.columns))
        )
        for shard, own in groupby(rows, key=itemgetter(0)):
            # repeated rows are neighbours
            once = (next(same) for _, same in groupby(own, key=lambda r: r[2:5]))
            texts = Texts.of((row[5], row[4]) for row in once)
            columns = [shard, len(texts.labels), int(texts.labels.sum()), texts.vocabulary.tobytes()]
            columns += [texts.index.tobytes(), texts.starts.tobytes(), texts.labels.tobytes()]
            kinds = [pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 4]
            arrays = [pa.array([c], k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in _SHARD.split(", ")])
        give_back()

    placed = dealt.repartitionById(n, "shard").sortWithinPartitions("shard", "order", "doc", "content", "label")
    return written(placed.mapInArrow(run, _SHARD), "shards")


def _added(shards: DataFrame, work: Callable[[Texts], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The sums over all shards of two arrays that `work` makes, the first with a row for each of the table's."""
    result = "shard int, part int, numbers binary"
    size = BUCKETS // PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                shard, _, _, *parts = (c[row] for c in batch.columns)
                kinds = (np.int32, np.int32, np.int64, np.int32)
                rows, index, starts, labels = (np.frombuffer(p.as_buffer(), k) for p, k in zip(parts, kinds))
                table, rest = work(Texts(rows.reshape(-1, _FEATURES), index, starts, labels))
                pieces = [table[i : i + size] for i in range(0, BUCKETS, size)]
                made = [(i, p.tobytes()) for i, p in enumerate(pieces) if p.any()] + [(-1, rest.tobytes())]
                numbers, contents = zip(*made)
                columns = [[shard.as_py()] * len(made), numbers, contents]
                arrays = [pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int32(), pa.binary()))]
                yield pa.RecordBatch.from_arrays(arrays, ["shard", "part", "numbers"])
        give_back()

    def add(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("shard")
        total = sum(np.frombuffer(x.as_buffer(), np.float32).astype(np.float64) for x in rows["numbers"])
        return pa.table({"part": rows["part"][:1], "numbers": pa.array([total.tobytes()], pa.binary())})

    each = shards.mapInArrow(run, result)
    summed = each.groupBy("part").applyInArrow(add, "part int, numbers binary")
    sums = {r.part: np.frombuffer(r.numbers) for r in summed.collect()}
    rest = sums.pop(-1)
    width = max((len(x) for x in sums.values()), default=0) // size
    table = np.zeros((BUCKETS, width))
    for part, numbers in sums.items():
        table[part * size : (part + 1) * size] = numbers.reshape(size, width)
    return table, rest


def _trained(shards: DataFrame, share: float) -> Network:
    """A network after `EPOCHS`, in each of which all shards begin with the same one.

    A row of the table moves by the mean of what the shards moved it, by how often each did; other
    weights by that of all shards, by their rows.
    """
    context = shards.sparkSession.sparkContext
    network = Network()
    table, _ = _added(shards, lambda texts: (texts.counts(), np.zeros(1, np.float32)))
    if table.shape[1]:
        network.start_from(table[:, 0].astype(np.float32), table[:, 1].astype(np.float32), share)
    for epoch in range(EPOCHS):
        begun = context.broadcast(network)

        def work(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
            own = pickle.loads(pickle.dumps(begun.value))
            changed = own.fit(texts, share, epoch)[:, None]
            moved = np.concatenate([(own.table - begun.value.table) * changed, changed], 1)
            n = np.float32(len(texts.labels))
            return moved, np.concatenate([p.ravel() * n for p in own.dense()] + [[n]]).astype(np.float32)

        table, rest = _added(shards, work)
        begun.destroy()
        if table.shape[1]:
            network.table += (table[:, :-1] / np.maximum(table[:, -1:], 1)).astype(np.float32)
        at = 0
        for weights in network.dense():
            weights[:] = (rest[at : at + weights.size] / rest[-1]).reshape(weights.shape)
            at += weights.size
    return network


def train(
    docs: DataFrame,
    labels: DataFrame,
    languages: Languages,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> Classifier:
    """A classifier from all documents with a label of 0 or 1, whole texts of any length.

    `labels` has a label per id. Rows with a null text or another label are left out; rows repeated
    with one id and text count once. With no row of one of the labels there is nothing to learn and
    all scores are 0. One row in `KEPT_BACK`, by a hash of the id, sets thresholds; if that leaves
    either part without one of the labels, all rows do both. Labels are sent to every task if they
    are few, else they and the texts are shuffled by their ids.
    """
    ship(docs.sparkSession)
    text = quoted(text_col).cast("string")
    usable = docs.filter(text.isNotNull()).select(quoted(id_col).alias("doc"), text.alias("text"))
    marks = labels.filter(quoted(label_col).isin(0, 1)).select(
        quoted(id_col).alias("doc"), quoted(label_col).cast("int").alias("label")
    )
    marks = written(marks.distinct(), "marks")
    # texts need not be sorted, nor spilled, to meet their labels
    known = usable.join(marks.hint("broadcast" if marks.count() <= BROADCAST_ROWS else "shuffle_hash"), "doc")
    order = F.xxhash64("doc")
    back = F.pmod(F.shiftright(order, 6), F.lit(KEPT_BACK)) == 0
    content = F.xxhash64("text").alias("content")
    known = written(
        known.select("doc", content, "label", order.alias("order"), back.alias("back"), "text"), "labelled"
    )
    chars = F.sum(F.char_length("text")).alias("chars")
    sizes = known.groupBy("back", "label").agg(F.count(F.lit(1)).alias("n"), chars).collect()
    if len({r.label for r in sizes}) < 2:
        return Classifier(None, languages, {None: 0.0})
    apart = len(sizes) == 4
    used = known.filter(~F.col("back")) if apart else known
    own = [r for r in sizes if not (apart and r.back)]
    n = max(math.ceil(sum(r.n for r in own) / SHARD_ROWS), math.ceil(sum(r.chars for r in own) / SHARD_CHARS), 1)
    shards = _shards(used.drop("back"), n)
    share = shards.agg(F.sum("toxic") / F.sum("n")).first()[0]
    classifier = Classifier(_trained(shards, share), languages, {None: 0.0})
    judged = _logits(known.filter("back") if apart else known, classifier, ["doc", "content", "label"])
    judged = written(judged.distinct().select("name", "logit", "label"), "judged")
    return Classifier(classifier.network, languages, best_thresholds(judged))


def _logits(rows: DataFrame, classifier: Classifier, own: list[str]) -> DataFrame:
    """The columns `own` of rows with a text, its logit and its language, as `name`."""
    model = rows.sparkSession.sparkContext.broadcast(classifier)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network, languages = model.value.network, model.value.languages
        for batch in batches:
            texts = [text.as_py() for text in batch.column(len(own))]
            logits = pa.array([network.logit(features(t)) for t in texts], pa.float64())
            names = pa.array([languages.best(t)[0] for t in texts], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], logits, names], [*own, "logit", "name"])
        give_back()

    chosen = rows.select(*own, "text")
    more = [T.StructField("logit", T.DoubleType()), T.StructField("name", T.StringType())]
    return chosen.mapInArrow(run, T.StructType([*chosen.drop("text").schema.fields, *more]))


def classify(docs: DataFrame, classifier: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: id_col, score (0 to 1) and predicted (1 from `CUT` on).

    Whole texts are read. A null text is scored as the empty one. An empty table gives no rows.
    Other columns are left out.
    """
    spark = docs.sparkSession
    ship(spark)
    model = spark.sparkContext.broadcast(classifier)
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = model.value.score
        for batch in batches:
            scores = pa.array([of(text.as_py()) for text in batch.column(1)], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), scores], ["doc", "score"])

    rows = docs.select(quoted(id_col).alias("doc"), quoted(text_col).cast("string").alias("text"))
    schema = T.StructType([T.StructField("doc", kind), T.StructField("score", T.DoubleType())])
    scored = rows.mapInArrow(run, schema)
    return scored.select(
        F.col("doc").alias(id_col), "score", (F.col("score") >= CUT).cast("int").alias("predicted")
    )


def fold(id_column: Column, of: int) -> Column:
    """crc32 of the id as text, modulo `of`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % of

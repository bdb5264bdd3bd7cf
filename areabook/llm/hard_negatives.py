"""Hard-negative mining by segment summary filtering (exact).

Rows are (vec_id, label, vector of integers). A score is the inner product with the anchor. Of every
vector the mean and the deviation (root of the summed squared distance from the mean) of each segment
are stored, for several widths of segments. Over a segment of L components

    L * mean_a * mean_b - dev_a * dev_b  <=  a . b  <=  L * mean_a * mean_b + dev_a * dev_b

(Cauchy-Schwarz on what is left after the means), so two products of the summaries, added up over the
segments, bound a score from both sides. Pairs go through the levels from wide to narrow segments;
a pair stays while its bounds leave it a chance. What passes the last level is scored exactly, the likeliest rows of
an anchor first: a row whose upper bound is under the k-th best score already known needs none.

* Positives of an anchor: the k best rows of its label.
* Negatives of a (anchor, positive): the best rows of other labels with a score from low to high of
  the positive's, as exact fractions; a pair also goes when its bounds lie outside all of the anchor's score ranges.

On Spark: rows are written once, packed in blocks of at most `BLOCK_ROWS` rows with their summaries;
anchors, a stated query set, likewise in blocks of `ANCHOR_ROWS`. Row blocks are dealt over groups, anchor
blocks are copied to each group, and one join by group meets every anchor block with every row
block: a task handles a bounded pair of blocks at a time, whatever label or vector is frequent. Each
pair of blocks returns its best rows an anchor (or anchor and positive); what is merged by window is that,
never scores. Positives need one pass, negatives a second.

Ties go to the smaller vec_id (NULL last), then to the row read first.

Edge cases: rows with a NULL label, a NULL vector, or NULL or non-finite components take no part; a row
with a NULL vec_id takes part but is no anchor; repeated rows are rows of their own (a copy of an anchor
is one of its positives, each copy of an anchor is an anchor); shorter vectors count as padded with zeros; a
negative positive score has no range (low > high), a score of 0 the range 0; components are clipped to
2**26 in size, within which 64-bit sums are exact up to 1,024 components (larger vectors are an error); an
empty table gives an empty result; other columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areabook.llm.common import stager

POSITIVES, NEGATIVES = 5, 3
#: Range of a negative's score as percents of the positive's.
LOW, HIGH = 50, 95
#: Widths of the segments, from the first filter to the last.
WIDTHS = (16, 4, 2)
BLOCK_ROWS, ANCHOR_ROWS = 4096, 256
#: Likeliest rows scored first to learn a cut, as a multiple of the rows asked for.
SEEDS = 8
LIMIT, MAX_WIDTH = 1 << 26, 1024
#: Sorts after every id.
NO_ID = np.iinfo(np.int64).max
_BLOCK = "n int, width int, ids binary, nulls binary, rids binary, labels binary, vectors binary, means binary, devs binary, extra binary"


def quantise(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, as integers."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def usable(rows: DataFrame, vector: str) -> DataFrame:
    """Rows with a label and a vector whose components are all finite numbers."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return rows.filter(F.col("label").isNotNull() & F.col(vector).isNotNull() & F.forall(vector, lambda x: fine(x.cast("double"))))


# ---- blocks ------------------------------------------------------------------------------------

def summaries(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Root-length-weighted means and deviations of all segments, the widths of WIDTHS side by side."""
    means, devs = [], []
    for width in WIDTHS:
        for at in range(0, v.shape[1], width):
            part = v[:, at:at + width].astype(np.float64)
            mean = part.mean(axis=1)
            means.append(mean * np.sqrt(part.shape[1]))
            devs.append(np.sqrt(((part - mean[:, None]) ** 2).sum(axis=1)))
    stack = lambda x: np.stack(x, axis=1) if x else np.zeros((len(v), 0))
    return stack(means), stack(devs)


def _levels(width: int) -> list[slice]:
    """Columns of the summaries that belong to each level."""
    out, at = [], 0
    for w in WIDTHS:
        n = -(-width // w)
        out.append(slice(at, at + n))
        at += n
    return out


def _pack(batches: Iterator[pa.RecordBatch], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            part = batch.slice(at, size)
            lists = part.column("vector")
            lengths = np.diff(lists.offsets.to_numpy())
            width = int(lengths.max(initial=0))
            if width > MAX_WIDTH:
                raise ValueError(f"vectors of {width} components; {MAX_WIDTH} at most")
            v = np.zeros((part.num_rows, width), dtype=np.int64)
            v[np.arange(width) < lengths[:, None]] = np.clip(lists.flatten().to_numpy(), -LIMIT, LIMIT)
            means, devs = summaries(v)
            ids = part.column("vec_id")
            nulls = ids.is_null().to_numpy(zero_copy_only=False)
            row = {"n": part.num_rows, "width": width, "ids": ids.fill_null(NO_ID).to_numpy().tobytes(), "nulls": nulls.tobytes(),
                   "rids": part.column("rid").to_numpy().tobytes(), "labels": part.column("label").to_numpy().tobytes(),
                   "vectors": v.astype(np.int32).tobytes(), "means": means.tobytes(), "devs": devs.tobytes(),
                   "extra": None if "extra" not in part.schema.names
                   else np.array(part.column("extra").to_pylist(), dtype=np.int64).tobytes()}
            yield pa.RecordBatch.from_pylist([row], schema)


class Block:
    """A packed block; `extra` is one row of integers an anchor (scores of its positives)."""

    def __init__(self, row: dict, prefix: str):
        self.n, self.width = row[prefix + "n"], row[prefix + "width"]
        read = lambda c, t, *shape: np.frombuffer(row[prefix + c], dtype=t).reshape(self.n, *shape)
        self.ids, self.rids, self.labels = read("ids", np.int64), read("rids", np.int64), read("labels", np.int64)
        self.nulls = read("nulls", np.bool_)
        self.vectors = read("vectors", np.int32, self.width)
        segments = sum(-(-self.width // w) for w in WIDTHS)
        self.means, self.devs = read("means", np.float64, segments), read("devs", np.float64, segments)
        self.extra = None if row.get(prefix + "extra") is None else read("extra", np.int64, -1)

    def prepare(self) -> Block:
        """Level by level: means, deviations, and the lengths that rounding is measured by; and the vectors for scoring."""
        self.levels = []
        for level in _levels(self.width):
            mean, dev = np.ascontiguousarray(self.means[:, level]), np.ascontiguousarray(self.devs[:, level])
            self.levels.append((mean, dev, np.sqrt((mean ** 2 + dev ** 2).sum(axis=1))))
        self.floats = self.vectors.astype(np.float64)
        self.largest = float(np.abs(self.floats).max(initial=0))
        return self

    def widened(self, width: int) -> Block:
        """The same rows with zeros appended (blocks of shorter vectors)."""
        if width > self.width:
            self.vectors = np.pad(self.vectors, ((0, 0), (0, width - self.width)))
            self.width = width
            self.means, self.devs = summaries(self.vectors)
        return self


def _times(matrix: np.ndarray, rows: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Products of the given rows with the vector; of all rows first where most are wanted."""
    return matrix[rows] @ vector if 4 * len(rows) < len(matrix) else (matrix @ vector)[rows]


def bounds(a: Block, i: int, b: Block, level: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lower bound, middle, upper bound) of the scores of a's row i with the given rows of b, by one level of segments."""
    (am, ad, al), (bm, bd, bl) = a.levels[level], b.levels[level]
    mean, dev = _times(bm, rows, am[i]), _times(bd, rows, ad[i])
    # rounding of the sums, against the product of the lengths; scores are integers
    dev = dev + (0.01 + 1e-12 * al[i] * bl[rows])
    return mean - dev, mean, mean + dev


def exact(a: Block, i: int, b: Block, rows: np.ndarray) -> np.ndarray:
    """Scores as integers: sums of doubles below 2^53 are exact, larger ones are added as 64-bit integers."""
    if a.largest * b.largest * a.width < 2**53:
        return _times(b.floats, rows, a.floats[i]).astype(np.int64)
    return b.vectors[rows].astype(np.int64) @ a.vectors[i].astype(np.int64)


def _cut(a: Block, i: int, b: Block, rows: np.ndarray, middle: np.ndarray, k: int, bottom: float, top: float) -> float:
    """The k-th best score of a range, as far as its likeliest rows show."""
    fit = np.flatnonzero(middle <= top)
    n = SEEDS * k
    if len(fit) > n:
        fit = fit[np.argpartition(middle[fit], len(fit) - n)[len(fit) - n:]]
    known = exact(a, i, b, rows[fit])
    known = np.sort(known[(known >= bottom) & (known <= top)])
    return known[-k] if len(known) >= k else bottom


def worth(a: Block, i: int, b: Block, rows: np.ndarray, k: int, ranges: list[tuple[float, float]]) -> np.ndarray:
    """The rows that can be among the k best of one of the score ranges, level by level; at the last level the likeliest rows of
    each range are scored, and a row under the k-th best score known in every range cannot be among the k best."""
    least, most = min(r[0] for r in ranges), max(r[1] for r in ranges)
    for level in range(len(b.levels)):
        low, middle, high = bounds(a, i, b, level, rows)
        if level == len(b.levels) - 1:
            least = min(_cut(a, i, b, rows, middle, k, *r) for r in ranges)
        rows = rows[(high >= least) & (low <= most)]
    return rows


def _best(scores: np.ndarray, rows: np.ndarray, b: Block, k: int) -> np.ndarray:
    """Places of the k best, by score, then id, then row."""
    if len(scores) > 4 * k:                       # ties at the k-th score stay in
        near = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        return near[_best(scores[near], rows[near], b, k)] if len(near) < len(scores) else near[
            np.lexsort((b.rids[rows], b.nulls[rows], b.ids[rows], -scores))[:k]]
    return np.lexsort((b.rids[rows], b.nulls[rows], b.ids[rows], -scores))[:k]


def best_positives(a: Block, b: Block, k: int) -> Iterator[tuple]:
    """(anchor, row, score) of the k best rows of the anchor's label in one pair of blocks."""
    for i in range(a.n):
        rows = np.flatnonzero((b.labels == a.labels[i]) & (b.rids != a.rids[i]))
        if len(rows):
            rows = worth(a, i, b, rows, k, [(-np.inf, np.inf)])
            scores = exact(a, i, b, rows)
            for j in _best(scores, rows, b, k):
                yield i, rows[j], int(scores[j])


def score_range(positive: np.ndarray, low: int = LOW, high: int = HIGH) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest integer scores from low to high percent of the positive's."""
    return -((-low * positive) // 100), (high * positive) // 100


def best_negatives(a: Block, b: Block, k: int, low: int, high: int) -> Iterator[tuple]:
    """(anchor, place of the positive score, row, score) of the k best rows of other labels in each range."""
    bottom, top = score_range(a.extra, low, high)
    for i in range(a.n):
        places = np.flatnonzero(bottom[i] <= top[i])
        rows = np.flatnonzero(b.labels != a.labels[i])
        if not len(places) or not len(rows):
            continue
        rows = worth(a, i, b, rows, k, [(bottom[i, p], top[i, p]) for p in places])
        scores = exact(a, i, b, rows)
        for p in places:
            inside = np.flatnonzero((scores >= bottom[i, p]) & (scores <= top[i, p]))
            for j in _best(scores[inside], rows[inside], b, k):
                yield i, p, rows[inside[j]], int(scores[inside[j]])


# ---- Spark -------------------------------------------------------------------------------------

_FOUND = "anchor_rid long, anchor_id long, place int, rid long, vec_id long, score long"


def _met(batches: Iterator[pa.RecordBatch], schema: pa.Schema, what: str, k: int, low: int, high: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for one in range(batch.num_rows):
            row = batch.slice(one, 1).to_pylist()[0]
            a, b = Block(row, "a_"), Block(row, "b_")
            width = max(a.width, b.width)
            a, b = a.widened(width).prepare(), b.widened(width).prepare()
            found = ([(i, 0, j, s) for i, j, s in best_positives(a, b, k)] if what == "positives"
                     else list(best_negatives(a, b, k, low, high)))
            if found:
                i, p, j, s = (np.array(x, dtype=np.int64) for x in zip(*found))
                yield pa.RecordBatch.from_arrays([
                    pa.array(a.rids[i]), pa.array(a.ids[i]), pa.array(p.astype(np.int32)), pa.array(b.rids[j]),
                    pa.array(b.ids[j], mask=b.nulls[j]), pa.array(s)], schema=schema)


def _mapped(df: DataFrame, fn, ddl: str, *args) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    types = StructType.fromDDL(ddl)
    schema = to_arrow_schema(types)
    return df.mapInArrow(lambda batches: fn(batches, schema, *args), types)


def _packed(rows: DataFrame, size: int) -> DataFrame:
    return _mapped(rows, _pack, _BLOCK, size)


def _grid(anchors: DataFrame, blocks: DataFrame, groups: int) -> DataFrame:
    """Every anchor block beside every row block: anchors are copied to each group of row blocks."""
    left = anchors.select(*[F.col(c).alias(f"a_{c}") for c in anchors.columns],
                          F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("grp"))
    right = blocks.select(*[F.col(c).alias(f"b_{c}") for c in blocks.columns if c not in ("grp", "extra")], "grp")
    # anchors grow with the corpus: a merge join, which streams them past the few row blocks of a group
    return left.join(right.hint("merge"), "grp").drop("grp")


def _ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "rid")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(rows: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
         high: int = HIGH, block_rows: int = BLOCK_ROWS, anchor_rows: int = ANCHOR_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of rows(vec_id, label,
    vector) for the rows where `anchors` holds; vector is an array of integers."""
    st = stager(rows.sparkSession, "negatives")
    base = st.stage(rows.select(F.monotonically_increasing_id().alias("rid"), F.col("vec_id").cast("long").alias("vec_id"),
                                F.col("label").cast("long").alias("label"), F.col("vector").cast("array<long>").alias("vector"),
                                F.coalesce(anchors, F.lit(False)).alias("anchor")), "rows")
    packed = st.stage(_packed(base.drop("anchor"), block_rows), "blocks")
    # a block's group: dealt by its first row, about four blocks a group
    groups = max(1, packed.count() // 4)
    blocks = packed.withColumn("grp", F.pmod(F.xxhash64("rids"), F.lit(groups)).cast("int"))
    asked = base.filter(F.col("anchor") & F.col("vec_id").isNotNull()).drop("anchor")

    found = _mapped(_grid(_packed(asked, anchor_rows), blocks, groups), _met, _FOUND, "positives", positives, low, high)
    pos = st.stage(_ranked(st.stage(found, "near"), ["anchor_rid"], positives)
                   .select("anchor_rid", F.col("rank").alias("nth"), F.col("vec_id").alias("positive_id"),
                           F.col("score").alias("positive_score")), "positives")
    # anchors with the scores of their positives; a missing one has no range
    none = F.transform(F.sequence(F.lit(1), F.lit(positives)), lambda i: F.lit(-1).cast("long"))
    scores = pos.groupBy("anchor_rid").agg(F.array_sort(F.collect_list(F.struct("nth", "positive_score"))).alias("s")).select(
        F.col("anchor_rid").alias("rid"), F.slice(F.concat(F.transform("s", lambda x: x["positive_score"]), none), 1, positives).alias("extra"))
    armed = _packed(asked.join(scores, "rid"), anchor_rows)
    found = _mapped(_grid(armed, blocks, groups), _met, _FOUND, "negatives", negatives, low, high)
    neg = _ranked(st.stage(found, "far").withColumn("nth", F.col("place") + 1), ["anchor_rid", "nth"], negatives)
    return (neg.select("anchor_rid", "nth", F.col("anchor_id"), F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
                       F.col("score").alias("negative_score"))
            .join(pos, ["anchor_rid", "nth"])
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))

"""Hard negatives by inner product, with angles to reference directions as a filter.

Each row keeps its vector in whole numbers, its norm, and its angles to a few reference directions. Angles obey
the triangle inequality: the angle of two rows lies between the largest difference and the smallest sum (or
complement of the sum) of their angles to any reference. The cosines of those limits, times both norms and
widened by more than rounding can move them, are bounds of the score. Only rows whose interval meets the
anchor's window are scored, exactly; a window's lower end rises as better rows are found. The same bounds,
taken over blocks of rows with similar angles, pass over whole blocks.

Anchors and rows are both dealt into parts, and every pair of parts is one group of a cogroup: its size is
bounded (``ROWS`` of each), whatever a label or a vector is worth. A part returns each anchor's best rows, and a
ranking window, limited before its shuffle, picks the best of all parts. Positives come first; their scores open
the windows in which negatives are sought.

A row with a NULL label, a NULL vector, or a component that is NULL or not finite takes no part. Components become
floor(scale * x). Rows may repeat, and ids as well: a row is never its own positive, its repetition may be. Equal
scores go by id, NULL ids last; a row without an id is no anchor. Vectors of different length have no score.
Scores are exact at any size; one that does not fit a long stops the job. An empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.shared import settle

REFERENCES = 16
ROWS = 65_536  # of a part, at most on average
BLOCK = 128  # rows bounded at once
ANGLE_SLACK = 1e-5  # radians; angles are stored in single precision
SCORE_SLACK = 1e-9  # of the product of the norms
EXACT = 2.0**53  # whole numbers below have exact sums in double precision


def whole_vectors(df: DataFrame, id: str, label: str, vector: str, scale: int) -> DataFrame:
    """(id, label, q) of the rows that take part."""
    whole = F.transform(F.col(vector), lambda x: x.cast("double"))
    finite = F.forall(whole, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    rows = df.filter(F.col(label).isNotNull() & F.col(vector).isNotNull() & finite)
    # floor() of a double would be a long and overflow; taking the remainder off keeps large whole numbers as they are.
    floored = F.transform(whole, lambda x: F.when(F.abs(x * scale) < 2.0**52, F.floor(x * scale).cast("double")).otherwise(x * scale))
    return rows.select(F.col(id).alias("id"), F.col(label).alias("label"), floored.alias("q"))


def directions(sample: list[list[float]], size: int) -> np.ndarray:
    """Unit vectors: the sampled rows of this length, made up by seeded random ones."""
    fill = np.random.default_rng(size).standard_normal((REFERENCES, size))
    rows = [x for x in (np.asarray(s) for s in sample) if len(x) == size and np.any(x)]
    out = np.vstack([*(x / np.abs(x).max() for x in rows), fill])[:REFERENCES]
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def pack(q: np.ndarray) -> bytes:
    """The smallest of int16, int32 and float64 that holds the numbers."""
    most = np.abs(q).max(initial=0)
    return q.astype(np.int16 if most < 2**15 else np.int32 if most < 2**31 else np.float64).tobytes()


def unpack(column: pa.Array, size: int) -> np.ndarray:
    kinds = {2 * size: np.int16, 4 * size: np.int32}
    out = np.empty((len(column), size))
    for i, x in enumerate(column):
        body = x.as_buffer()
        out[i] = np.frombuffer(body, kinds.get(len(body), np.float64)) if size else 0
    return out


def with_angles(rows: DataFrame, sample: list[list[float]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        for batch in batches:
            packed, norms, angles, sizes = [], [], [], []
            for x in batch.column("q"):
                q = x.values.to_numpy()
                if len(q) not in known:
                    known[len(q)] = directions(sample, len(q))
                scale = np.abs(q).max(initial=0) or 1.0
                length = np.linalg.norm(q / scale)
                cosines = known[len(q)] @ (q / scale / length) if length else np.zeros(REFERENCES)
                packed.append(pack(q))
                norms.append(float(length * scale))
                angles.append(np.arccos(np.clip(cosines, -1, 1)).astype(np.float32).tobytes())
                sizes.append(len(q))
            columns = [batch.column("id"), batch.column("label"), sizes, packed, norms, angles]
            kinds = [None, None, pa.int32(), pa.binary(), pa.float64(), pa.binary()]
            arrays = [c if t is None else pa.array(c, t) for c, t in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "label", "size", "q", "norm", "angles"])

    types = dict(rows.dtypes)
    schema = f"id {types['id']}, label {types['label']}, size int, q binary, norm double, angles binary"
    return rows.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id())


class Part:
    """Rows of one part, ordered so that neighbours have similar angles, with limits of their blocks."""

    def __init__(self, table: pa.Table):
        size = table["size"][0].as_py()
        angles = np.vstack([np.frombuffer(x.as_buffer(), np.float32) for x in table["angles"]]).astype(np.float64)
        label = table["label"].to_numpy()
        nearest = angles.argmin(axis=1)
        order = np.lexsort((angles.min(axis=1), nearest, label))
        self.angles, self.label = angles[order], label[order]
        self.norm = table["norm"].to_numpy()[order]
        self.q = unpack(table["q"].combine_chunks(), size)[order]
        self.row = table["row"].to_numpy()[order]
        no_id = table["id"].is_null().to_numpy(zero_copy_only=False)[order]
        self.tie = np.lexsort((table["id"].fill_null(0).to_numpy()[order], no_id)).argsort()  # place by id, NULL last
        self.most = np.abs(self.q).max(initial=0) * max(size, 1)
        starts = np.arange(0, len(order), BLOCK)
        self.low, self.high = (f.reduceat(self.angles, starts) for f in (np.minimum, np.maximum))
        self.small, self.large = (f.reduceat(self.norm, starts) for f in (np.minimum, np.maximum))
        self.order, self.starts = order, starts

    def scores(self, q: np.ndarray, rows: np.ndarray) -> np.ndarray:
        if self.most * np.abs(q).max(initial=0) < EXACT:
            return (self.q[rows] @ q).astype(np.int64)
        mine = [int(x) for x in q]
        return np.array([sum(a * int(b) for a, b in zip(mine, self.q[r])) for r in rows], np.int64)


def _bounds(near: np.ndarray, far: np.ndarray, small: np.ndarray, large: np.ndarray, norm: float) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper) limits of scores from limits of the angles and norms."""
    near = np.cos(np.clip(near - ANGLE_SLACK, 0, np.pi))
    far = np.cos(np.clip(far + ANGLE_SLACK, 0, np.pi))
    with np.errstate(over="ignore", invalid="ignore"):
        slack = norm * large * SCORE_SLACK + 1
        upper = norm * np.where(near >= 0, large, small) * near + slack
        lower = norm * np.where(far >= 0, small, large) * far - slack
    return np.where(np.isfinite(lower), lower, -np.inf), np.where(np.isfinite(upper), upper, np.inf)


def block_bounds(part: Part, angles: np.ndarray, norm: float) -> tuple[np.ndarray, np.ndarray]:
    near = np.maximum(angles - part.high, part.low - angles).max(axis=1)
    far = np.minimum(angles + part.high, 2 * np.pi - angles - part.low).min(axis=1)
    return _bounds(near, far, part.small, part.large, norm)


def row_bounds(part: Part, rows: np.ndarray, angles: np.ndarray, norm: float) -> tuple[np.ndarray, np.ndarray]:
    theirs = part.angles[rows]
    near = np.abs(theirs - angles).max(axis=1)
    both = theirs + angles
    far = np.minimum(both, 2 * np.pi - both).min(axis=1)
    return _bounds(near, far, part.norm[rows], part.norm[rows], norm)


def best_in_windows(
    part: Part, q: np.ndarray, angles: np.ndarray, norm: float, wanted: np.ndarray, windows: list[tuple[float, float]], count: int
) -> list[list[tuple[int, int]]]:
    """For each window (least, most score), its first ``count`` (row of the part, score) by score and id.

    ``wanted`` says which rows are of a kind the anchor seeks.
    """
    low = np.array([w[0] for w in windows], float)
    high = np.array([w[1] for w in windows], float)
    found: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in windows]
    lower, upper = block_bounds(part, angles, norm)
    has = np.logical_or.reduceat(wanted, part.starts)
    order = np.argsort(-upper, kind="stable")
    order = order[has[order]]
    at, step = 0, 4
    while at < len(order) and upper[order[at]] >= low.min():
        blocks = order[at : at + step]
        at, step = at + step, step * 2
        meets = ((upper[blocks, None] >= low) & (lower[blocks, None] <= high)).any(axis=1)
        rows = (part.starts[blocks[meets], None] + np.arange(BLOCK)).ravel()
        rows = rows[rows < len(part.row)]
        rows = rows[wanted[rows]]
        if not len(rows):
            continue
        least, most = row_bounds(part, rows, angles, norm)
        rows = rows[((most[:, None] >= low) & (least[:, None] <= high)).any(axis=1)]
        scores = part.scores(q, rows)
        for w, (first, last) in enumerate(windows):
            fits = (scores >= first) & (scores <= last)
            if not fits.any():
                continue
            all_rows = np.concatenate([found[w][0], rows[fits]])
            all_scores = np.concatenate([found[w][1], scores[fits]])
            top = np.lexsort((part.tie[all_rows], -all_scores))[:count]
            found[w] = all_rows[top], all_scores[top]
            if len(top) == count:
                low[w] = max(low[w], all_scores[top[-1]])
    return [list(zip(r.tolist(), s.tolist())) for r, s in found]


def _dealt(anchors: DataFrame, rows: DataFrame, search, schema: str, many_anchors: int, many_rows: int) -> DataFrame:
    """Every part of the anchors with every part of the rows; ``search`` gets two Arrow tables."""
    spark = rows.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    of_anchors = max(1, math.ceil(many_anchors / ROWS))
    of_rows = max(math.ceil(many_rows / ROWS), min(partitions, math.ceil(many_rows / BLOCK)), 1)
    keys = ["size", "anchor_part", "row_part"]

    def part(count: int) -> Column:
        return F.pmod(F.xxhash64("row"), F.lit(count)).cast("int")

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    left = anchors.select("*", part(of_anchors).alias("anchor_part"), every(of_rows).alias("row_part"))
    right = rows.select("*", every(of_anchors).alias("anchor_part"), part(of_rows).alias("row_part"))
    tasks = max(partitions, of_anchors * of_rows)
    left, right = (x.repartition(tasks, *keys) for x in (left, right))
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, schema)


def _anchors_of(table: pa.Table) -> Iterator[tuple[dict, np.ndarray, np.ndarray]]:
    size = table["size"][0].as_py()
    vectors = unpack(table["q"].combine_chunks(), size)
    for i, row in enumerate(table.drop_columns(["q"]).to_pylist()):
        yield row, vectors[i], np.frombuffer(row["angles"], np.float32).astype(np.float64)


def hard_negatives(
    df: DataFrame,
    anchors: Column,
    *,
    id: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 10,
    least: int = 30,
    most: int = 90,
) -> DataFrame:
    """For each anchor and each of its ``positives`` best rows of the same label, the ``negatives`` best rows of other
    labels whose score is ``least`` to ``most`` per cent of the positive's.

    ``anchors`` is a condition on the column ``id``. Returns anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score, and the rows' own numbers anchor_row, positive_row and negative_row.
    """
    rows = whole_vectors(df, id, label, vector, scale)
    sample = [r.q for r in rows.orderBy(F.xxhash64("id", "q")).limit(REFERENCES).collect()]
    rows = settle(with_angles(rows, sample), "angles")
    queries = rows.filter(anchors)
    sizes = rows.agg(F.count("*").alias("rows"), F.count_if(anchors).alias("anchors")).first()
    id_type = dict(rows.dtypes)["id"]

    def near(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {c: [] for c in ("anchor_row", "positive_row", "positive_score", "place")}
        if left.num_rows and right.num_rows:
            part = Part(right)
            for row, q, angles in _anchors_of(left):
                wanted = (part.label == row["label"]) & (part.row != row["row"])
                (best,) = best_in_windows(part, q, angles, row["norm"], wanted, [(-math.inf, math.inf)], positives) if wanted.any() else ([],)
                for r, s in best:
                    out["anchor_row"].append(row["row"])
                    out["positive_row"].append(int(part.row[r]))
                    out["positive_score"].append(s)
                    out["place"].append(int(part.order[r]))
        ids = right["id"].take(pa.array(out.pop("place"), pa.int64())).combine_chunks()
        return pa.table({k: pa.array(v, pa.int64()) for k, v in out.items()} | {"positive_id": ids})

    schema = f"anchor_row long, positive_row long, positive_score long, positive_id {id_type}"
    found = _dealt(queries, rows, near, schema, sizes.anchors, sizes.rows)
    by_score = Window.partitionBy("anchor_row").orderBy(F.desc("positive_score"), F.asc_nulls_last("positive_id"), "positive_row")
    found = found.withColumn("n", F.row_number().over(by_score)).filter(F.col("n") <= positives)
    lists = found.groupBy("anchor_row").agg(F.sort_array(F.collect_list(F.struct("n", "positive_id", "positive_score", "positive_row"))).alias("positives"))
    lists = lists.select(F.col("anchor_row").alias("row"), "positives", F.col("positives.positive_score").alias("positive_scores"))
    opened = settle(queries.join(lists, "row"), "positives")

    def far(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {c: [] for c in ("anchor_row", "n", "negative_row", "negative_score", "place")}
        if left.num_rows and right.num_rows:
            part = Part(right)
            for row, q, angles in _anchors_of(left):
                wanted = part.label != row["label"]
                open_ = [(n, -(-least * p // 100), most * p // 100) for n, p in enumerate(row["positive_scores"], 1)]
                open_ = [w for w in open_ if w[1] <= w[2]]
                if not open_ or not wanted.any():
                    continue
                best = best_in_windows(part, q, angles, row["norm"], wanted, [w[1:] for w in open_], negatives)
                for (n, _, _), rows_of_window in zip(open_, best):
                    for r, s in rows_of_window:
                        out["anchor_row"].append(row["row"])
                        out["n"].append(n)
                        out["negative_row"].append(int(part.row[r]))
                        out["negative_score"].append(s)
                        out["place"].append(int(part.order[r]))
        ids = right["id"].take(pa.array(out.pop("place"), pa.int64())).combine_chunks()
        return pa.table({k: pa.array(v, pa.int64()) for k, v in out.items()} | {"negative_id": ids})

    schema = f"anchor_row long, n long, negative_row long, negative_score long, negative_id {id_type}"
    narrow = opened.select("row", "label", "size", "q", "norm", "angles", "positive_scores")
    found = _dealt(narrow, rows, far, schema, sizes.anchors, sizes.rows)
    by_score = Window.partitionBy("anchor_row", "n").orderBy(F.desc("negative_score"), F.asc_nulls_last("negative_id"), "negative_row")
    found = found.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= negatives)
    out = found.join(opened.select(F.col("row").alias("anchor_row"), F.col("id").alias("anchor_id"), "positives"), "anchor_row")
    positive = F.element_at("positives", F.col("n").cast("int"))
    return out.select(
        "anchor_id",
        positive["positive_id"].alias("positive_id"),
        "rank",
        "negative_id",
        positive["positive_score"].alias("positive_score"),
        "negative_score",
        "anchor_row",
        positive["positive_row"].alias("positive_row"),
        "negative_row",
    )

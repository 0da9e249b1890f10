"""Hard-negative mining by angular triangle filtering.

Every row keeps its angles to a few reference directions. The angle between an anchor and a
row lies between the difference and the sum of their angles to any reference; as a
cosine times both norms this bounds their score. Rows are dealt into blocks of
like label, reference and angle, so a block has narrow windows of angles and norms.
Only blocks, and in them only rows, whose bounds reach into a window that is asked
for get their integer score.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinloom.llm.common import map_rows, written

SCALE = 256
REFERENCES = 24  # directions, taken from SAMPLE rows
SAMPLE = 1024
BLOCK = 1024  # rows
ANCHORS = 512  # anchors of a block
_SLICES = 16
_SLACK = 1e-5  # radians and share of a norm; far above the error of the angles
_EXACT = float(1 << 53)
_LONG = float((1 << 63) - 1024)
_MOST = 4_500_000_000_000_000_000
_COMPONENTS = 1 << 21  # of memory only: differences to references held at once
_HELD = 1 << 18  # of memory only: rows a task keeps before it gives them on

_ROW = "vec_id long, label long, width int, home int, angle double, data binary, angles binary, norm double"
_BLOCK = (
    "width int, size int, least_label long, greatest_label long, ids binary, labels binary, wide int, data binary, "
    "home binary, angle binary, norms binary, near binary, far binary, short double, long double, "
    "first struct<label:long,home:int,angle:double>, last struct<label:long,home:int,angle:double>"
)
_PLACE = pa.struct([("label", pa.int64()), ("home", pa.int32()), ("angle", pa.float64())])


def _integers(vectors: list, scale: int) -> list[np.ndarray | None]:
    """floor(scale * x) of each vector; None where it is null or holds null or non-finite components."""
    out = []
    for v in vectors:
        ok = v is not None and None not in v and bool(np.isfinite(np.array(v, np.float64)).all())
        out.append(np.clip(np.floor(scale * np.array(v, np.float64)), -_LONG, _LONG).astype(np.int64) if ok else None)
    return out


def _angles(values: np.ndarray, references: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Angles of rows to unit vectors, and the rows' norms; a zero row has a right angle to all."""
    real = values.astype(np.float64)
    norms = np.sqrt((real**2).sum(axis=1))
    units = real / np.where(norms > 0, norms, 1)[:, None]
    # atan2 of both halves is exact for small angles too, where arccos is not.
    apart = units[:, None, :] - references[None]
    together = units[:, None, :] + references[None]
    found = 2 * np.arctan2(np.sqrt((apart**2).sum(axis=2)), np.sqrt((together**2).sum(axis=2)))
    found[norms == 0] = np.pi / 2
    return found, norms


def _referred(references: dict[int, np.ndarray], scale: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (vec_id, label, vector) with their angles to the references of their width."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_width: dict[int, list[int]] = {}
            values = _integers(batch.column(2).to_pylist(), scale)
            keys = batch.column(0).to_pylist()
            for i, v in enumerate(values):
                if v is not None and keys[i] is not None:
                    by_width.setdefault(v.size, []).append(i)
            for width, rows in by_width.items():
                step = max(1, min(512, _COMPONENTS // (REFERENCES * max(width, 1))))
                for at in range(0, len(rows), step):
                    some = rows[at : at + step]
                    whole = np.array([values[i] for i in some], np.int64).reshape(len(some), width)
                    angles, norms = _angles(whole, references.get(width, np.empty((0, width))))
                    home = angles.argmin(axis=1) if angles.shape[1] else np.zeros(len(some), np.int64)
                    angle = angles[np.arange(len(some)), home] if angles.shape[1] else np.zeros(len(some))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(some), batch.column(1).take(some), pa.array([width] * len(some), pa.int32()),
                         pa.array(home.astype(np.int32)), pa.array(angle), pa.array([r.tobytes() for r in whole], pa.binary()),
                         pa.array([a.tobytes() for a in angles], pa.binary()), pa.array(norms)],
                        ["vec_id", "label", "width", "home", "angle", "data", "angles", "norm"],
                    )

    return run


def _place(row: dict) -> dict:
    return {name: row[name] for name in ("label", "home", "angle")}


def _packed(block: int, every_angle: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sorted rows to blocks of one width each, values in as few bytes as hold them."""

    def packed(rows: list[dict]) -> pa.RecordBatch:
        width = rows[0]["width"]
        values = np.stack([np.frombuffer(r["data"], np.int64) for r in rows])
        angles = np.stack([np.frombuffer(r["angles"], np.float64) for r in rows])
        kept = angles if every_angle else np.array([r["angle"] for r in rows])[: None if angles.shape[1] else 0]
        most = int(np.abs(values).max(initial=0))
        wide = 2 if most < 1 << 15 else 4 if most < 1 << 31 else 8
        labels, norms = [r["label"] for r in rows], np.array([r["norm"] for r in rows])
        row = [
            (width, pa.int32()), (len(rows), pa.int32()), (min(labels), pa.int64()), (max(labels), pa.int64()),
            (np.array([r["vec_id"] for r in rows], np.int64).tobytes(), pa.binary()),
            (np.array(labels, np.int64).tobytes(), pa.binary()), (wide, pa.int32()),
            (values.astype(f"<i{wide}").tobytes(), pa.binary()),
            (np.array([r["home"] for r in rows], np.int32).tobytes(), pa.binary()),
            (kept.astype(np.float32).tobytes(), pa.binary()), (norms.tobytes(), pa.binary()),
            (angles.min(axis=0).tobytes(), pa.binary()), (angles.max(axis=0).tobytes(), pa.binary()),
            (float(norms.min()), pa.float64()), (float(norms.max()), pa.float64()),
            (_place(rows[0]), _PLACE), (_place(rows[-1]), _PLACE),
        ]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in row], [c.split(" ")[0] for c in _BLOCK.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and (len(held) == block or held[0]["width"] != row["width"]):
                    yield packed(held)
                    held = []
                held.append(row)
        if held:
            yield packed(held)

    return run


class _Block:
    """The arrays of a block, read from the columns that start with ``before``."""

    def __init__(self, row: dict, before: str = ""):
        def array(name: str, kind) -> np.ndarray:
            return np.frombuffer(row[before + name], kind)

        self.ids, self.labels, self.home = array("ids", np.int64), array("labels", np.int64), array("home", np.int32)
        size, self.width = self.ids.size, row[before + "width"]
        self.values = array("data", f"<i{row[before + 'wide']}").reshape(size, self.width)
        self.near, self.far = array("near", np.float64), array("far", np.float64)
        self.angles = array("angle", np.float32).reshape(size, -1 if self.near.size else 0).astype(np.float64)
        self.norms = array("norms", np.float64)


def _interval(near: np.ndarray, far: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest angle between two things whose angles to each reference (last axis) lie in the two windows."""
    shape = np.broadcast_shapes(near.shape, low.shape)[:-1]
    if not near.shape[-1]:
        return np.zeros(shape), np.full(shape, np.pi)
    least = np.maximum(near - high, low - far).max(axis=-1)
    around = 2 * np.pi - (near + low)  # past the opposite of the reference
    greatest = np.minimum(far + high, around).min(axis=-1)
    return np.maximum(least - _SLACK, 0), np.minimum(np.maximum(greatest, 0) + _SLACK, np.pi)


def _bounds(least: np.ndarray, greatest: np.ndarray, short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score at these angles and products of norms, rounded outwards."""
    top, bottom = np.cos(least), np.cos(greatest)
    upper = np.where(top > 0, top * long, top * short)
    lower = np.where(bottom > 0, bottom * short, bottom * long)
    reach = long * 1e-9 + 1
    return np.clip(lower - reach, -_MOST, _MOST), np.clip(upper + reach, -_MOST, _MOST)


def _limits(floor: np.ndarray, ceiling: np.ndarray, short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest angle at which a score from ``floor`` to ``ceiling`` can be, at such products of norms."""
    reach = long * 1e-9 + 1
    low, high = np.where(floor <= -_MOST, -np.inf, floor - reach), np.where(ceiling >= _MOST, np.inf, ceiling + reach)
    with np.errstate(divide="ignore", invalid="ignore"):
        top = np.where(high > 0, high / short, high / long)
        bottom = np.where(low > 0, low / long, low / short)
    greatest = np.arccos(np.clip(np.nan_to_num(bottom, nan=-1.0), -1, 1))
    least = np.arccos(np.clip(np.nan_to_num(top, nan=1.0), -1, 1))
    return least - _SLACK, greatest + _SLACK


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    reach = float(np.abs(a.astype(np.float64)).max(initial=0)) * float(np.abs(b.astype(np.float64)).max(initial=0)) * max(a.shape[1], 1)
    if reach < _EXACT:  # whole numbers in doubles are exact
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return np.clip(a.astype(object) @ b.T.astype(object), -_MOST, _MOST).astype(np.int64)


def _best(keys: list[np.ndarray], score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each key: higher scores first, then smaller ids."""
    order = np.lexsort((ids, -score, *reversed(keys)))
    same = np.ones(order.size, bool)
    for key in keys:
        same[1:] &= key[order][1:] == key[order][:-1]
    same[:1] = False
    starts = np.flatnonzero(~same)
    place = np.arange(order.size) - np.repeat(starts, np.diff(np.append(starts, order.size)))
    return order[place < k]


_FOUND = "a_block long, slot int, place int, vec_id long, score long"


def _searched(k: int, same: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The k best rows of each window of each anchor among a task's blocks.

    ``low`` and ``high`` hold the windows of an anchor block, ``windows`` to an anchor;
    a row counts if it has the anchor's label (``same``) or another, and another id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        size = 0

        def best() -> list[np.ndarray]:
            whole = [np.concatenate(c) for c in zip(*held)]
            return [c[_best(whole[:3], whole[4], whole[3], k)] for c in whole]

        def given(columns: list[np.ndarray]) -> pa.RecordBatch:
            a_block, slot, place, ids, score = columns
            return pa.RecordBatch.from_arrays(
                [pa.array(a_block), pa.array(slot.astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(ids), pa.array(score)],
                ["a_block", "slot", "place", "vec_id", "score"],
            )

        for batch in batches:
            for row in batch.to_pylist():
                a, b = _Block(row, "a_"), _Block(row)
                low = np.frombuffer(row["low"], np.int64).reshape(a.ids.size, -1)
                high = np.frombuffer(row["high"], np.int64).reshape(low.shape)
                found = _in_windows(a, b, low, high, same)
                if found[0].size:
                    slot, place, at, score = found
                    keep = _best([slot, place], score, b.ids[at], k)
                    held.append([np.full(keep.size, row["a_block"]), slot[keep], place[keep], b.ids[at[keep]], score[keep]])
                    size += keep.size
                if size > _HELD:
                    held = [best()]
                    size = held[0][0].size
                    if size > _HELD // 2:
                        yield given(held[0])
                        held, size = [], 0
        if held:
            yield given(best())

    return run


def _in_windows(a: _Block, b: _Block, low: np.ndarray, high: np.ndarray, same: bool) -> tuple[np.ndarray, ...]:
    """(anchor, window, row, score) of all rows of ``b`` that lie in a window of an anchor of ``a``."""
    nothing = (np.empty(0, np.int64),) * 4
    asked = low <= high
    floor = np.where(asked, low, _MOST + 1).min(axis=1, initial=_MOST + 1)
    ceiling = np.where(asked, high, -_MOST - 1).max(axis=1, initial=-_MOST - 1)
    # The block as a whole, then its rows by their own angles.
    least, greatest = _interval(a.angles, a.angles, b.near[None], b.far[None])
    lower, upper = _bounds(least, greatest, a.norms * b.norms.min(), a.norms * b.norms.max())
    anchors = np.flatnonzero((upper >= floor) & (lower <= ceiling))
    if not anchors.size:
        return nothing
    reached = np.ones((anchors.size, b.ids.size), bool)
    if b.near.size:
        to_home, own = a.angles[anchors][:, b.home], b.angles[:, 0]
        nearest, farthest = _limits(
            floor[anchors], ceiling[anchors], a.norms[anchors] * b.norms.min(), a.norms[anchors] * b.norms.max()
        )
        reached = np.abs(to_home - own) <= farthest[:, None] + _SLACK
        together = to_home + own
        reached &= np.minimum(together, 2 * np.pi - together) >= nearest[:, None] - _SLACK
    label = a.labels[anchors, None] == b.labels[None]
    reached &= (label if same else ~label) & (a.ids[anchors, None] != b.ids[None])
    rows = np.flatnonzero(reached.any(axis=0))
    if not rows.size:
        return nothing
    scores = _scores(a.values[anchors], b.values[rows])
    reached = reached[:, rows]
    parts = []
    for w in range(low.shape[1]):
        inside = reached & (scores >= low[anchors, w, None]) & (scores <= high[anchors, w, None])
        i, j = np.nonzero(inside)
        parts.append((anchors[i], np.full(i.size, w), rows[j], scores[i, j]))
    return tuple(np.concatenate(p) for p in zip(*parts)) if parts else nothing


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (a_block, size, count, list of (slot, place, low, high)) to arrays by slot and place, empty where none is asked."""
    for batch in batches:
        for row in batch.to_pylist():
            low = np.full((row["size"], row["count"]), 1, np.int64)
            high = np.zeros_like(low)
            for w in row["windows"]:
                low[w["slot"], w["place"]], high[w["slot"], w["place"]] = w["low"], w["high"]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["a_block"]], pa.int64()), pa.array([low.tobytes()]), pa.array([high.tobytes()])],
                ["a_block", "low", "high"],
            )


def _reaching(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of blocks whose bounds reach into what the anchors ask for."""

    def stacked(batch: pa.RecordBatch, name: str, size: int) -> np.ndarray:
        return np.frombuffer(b"".join(batch.column(name).to_pylist()), np.float64).reshape(batch.num_rows, size)

    for batch in batches:
        sizes = np.array([len(x) // 8 for x in batch.column("near").to_pylist()])
        for size in np.unique(sizes).tolist():
            some = batch.take(pa.array(np.flatnonzero(sizes == size)))
            near, far, a_near, a_far = (stacked(some, c, size) for c in ("near", "far", "a_near", "a_far"))
            short, long, a_short, a_long, floor, ceiling = (
                some.column(c).to_numpy() for c in ("short", "long", "a_short", "a_long", "floor", "ceiling")
            )
            lower, upper = _bounds(*_interval(a_near, a_far, near, far), a_short * short, a_long * long)
            kept = pa.array(np.flatnonzero((upper >= floor) & (lower <= ceiling)))
            yield pa.RecordBatch.from_arrays([some.column(c).take(kept) for c in ("a_block", "block")], ["a_block", "block"])


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row (a_block, slot, anchor_id) for every anchor."""
    for batch in batches:
        for block, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            names = np.frombuffer(ids, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(names.size, block)), pa.array(np.arange(names.size, dtype=np.int32)), pa.array(names)],
                ["a_block", "slot", "anchor_id"],
            )


def _divided(part: int, unit: int, up: bool):
    """part * score / unit as a whole number, rounded up or down and held within the scores."""
    sign = -1 if up else 1
    product = f"(cast({sign * part} as decimal(12, 0)) * cast(score as decimal(20, 0)))"
    down = f"({product} - pmod({product}, cast({unit} as decimal(12, 0)))) / cast({unit} as decimal(12, 0))"
    return F.expr(f"cast(least(greatest({sign} * {down}, -{_MOST}), {_MOST}) as long)")


def _reference_rows(rows: DataFrame, scale: int) -> dict[int, np.ndarray]:
    """Unit vectors by width: of SAMPLE rows, each the one farthest from those before it."""
    sample = rows.where("vec_id is not null and embedding is not null").orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE)
    by_width: dict[int, list] = {}
    for v in _integers([r.embedding for r in sample.select("embedding").collect()], scale):
        if v is not None and v.any():
            by_width.setdefault(v.size, []).append(v.astype(np.float64) / np.sqrt((v.astype(np.float64) ** 2).sum()))
    found = {}
    for width, vectors in by_width.items():
        units = np.array(vectors)
        picked, nearest = [0], units @ units[0]
        while len(picked) < min(REFERENCES, len(units)):
            picked.append(int(nearest.argmin()))
            nearest = np.maximum(nearest, units @ units[picked[-1]])
        found[width] = units[picked]
    return found


def mined(rows: DataFrame, anchors, positives: int, negatives: int, window: tuple[int, int, int], scale: int = SCALE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor.

    ``rows`` has (vec_id long, label, embedding); ``anchors`` is a condition on vec_id and
    label. Components become floor(scale * x), a score is the integer inner product, held
    within 4.5e18 on either side. An anchor's positives are its best ``positives`` rows of the same
    label; with ``window`` = (low, high, unit) each has as negatives the best rows of
    other labels with low * positive_score <= unit * negative_score <= high * positive_score.
    Ties go to the smaller vec_id; rows that share the anchor's id are no candidates of it;
    repeated rows are rows of their own, as anchors too. Rows whose vec_id, label or
    vector is null or whose vector holds null or non-finite components take no part,
    vectors of another length meet only those of theirs. Fewer rows than asked for
    are all given, a positive without negatives gives none. An empty table gives no
    rows, further columns are not read. Angles only leave out what can't count: the
    SAMPLE rows that the references come from decide on speed alone.
    """
    low, high, unit = window
    columns = rows.select("vec_id", F.col("label").cast("long").alias("label"), "embedding").where("label is not null")
    references = _reference_rows(columns, scale)
    placed = written(map_rows(columns, ["vec_id", "label", "embedding"], _ROW, _referred(references, scale)))
    order = ["width", "label", "home", "angle", "vec_id"]

    def blocks(of: DataFrame, size: int, every_angle: bool) -> DataFrame:
        in_order = of.repartitionByRange(*order).sortWithinPartitions(*order)
        packed = in_order.mapInArrow(_packed(size, every_angle), _BLOCK)
        return written(packed.withColumn("block", F.monotonically_increasing_id()))

    table = blocks(placed, BLOCK, False)
    asked = blocks(placed.where(anchors), ANCHORS, True)
    asked = written(asked.select(*[F.col(c).alias(f"a_{c}") for c in asked.columns]))
    slots = asked.select("a_block", "a_ids").mapInArrow(_slots, "a_block long, slot int, anchor_id long")
    # What is known of the blocks without their rows; slices of it meet in tasks of their own.
    heads = ["width", "block", "least_label", "greatest_label", "near", "far", "short", "long", "first", "last"]
    small = table.select(*heads).withColumn("slice", F.pmod(F.xxhash64("block"), F.lit(_SLICES)))
    a_small = asked.select(*[f"a_{c}" for c in heads], F.expr(f"explode(sequence(0L, {_SLICES - 1}L))").alias("slice"))
    pairs = a_small.join(small, (F.col("a_width") == F.col("width")) & (a_small["slice"] == small["slice"])).select(
        *[f"a_{c}" for c in heads], *heads, small["slice"].alias("slice")
    )
    alike = pairs.where("a_least_label <= greatest_label and least_label <= a_greatest_label")

    def searched(keys: DataFrame, windows: DataFrame, count: int, k: int, same: bool) -> DataFrame:
        """The k best of every window (a_block, slot, place, low, high) over the blocks of ``keys``."""
        sizes = asked.select(F.col("a_block"), F.col("a_size").alias("size"), F.lit(count).alias("count"))
        arrays = (
            windows.groupBy("a_block").agg(F.collect_list(F.struct("slot", "place", "low", "high")).alias("windows"))
            .join(sizes, "a_block").mapInArrow(_windows, "a_block long, low binary, high binary")
        )
        span = windows.groupBy("a_block").agg(F.min("low").alias("floor"), F.max("high").alias("ceiling"))
        bounds = ["near", "far", "short", "long"]
        reach = map_rows(
            keys.join(span, "a_block"), ["a_block", "block", "floor", "ceiling", *bounds, *[f"a_{c}" for c in bounds]],
            "a_block long, block long", _reaching,
        )
        work = reach.join(asked.join(arrays, "a_block"), "a_block").join(table.drop("first", "last", "short", "long"), "block")
        best = Window.partitionBy("a_block", "slot", "place").orderBy(F.desc("score"), "vec_id")
        found = work.mapInArrow(_searched(k, same), _FOUND)
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    def best_of(first: DataFrame, keys: DataFrame, windows: DataFrame, count: int, k: int, same: bool) -> DataFrame:
        """As ``searched``; a look at the blocks of ``first`` tells how good a row must be at least."""
        seen = searched(first, windows, count, k, same).where(F.col("rank") == k)
        floors = seen.select("a_block", "slot", "place", F.col("score").alias("floor"))
        raised = windows.join(floors, ["a_block", "slot", "place"], "left").select(
            "a_block", "slot", "place", F.greatest("low", "floor").alias("low"), "high"
        )
        return searched(keys, written(raised), count, k, same)

    everything = slots.select(
        "a_block", "slot", F.lit(0).alias("place"), F.lit(-_MOST).alias("low"), F.lit(_MOST).alias("high")
    )
    beside = alike.where("a_first <= last and first <= a_last")
    liked = written(best_of(beside, alike, everything, 1, positives, True).select(
        "a_block", "slot", (F.col("rank") - 1).alias("place"), F.col("vec_id").alias("positive_id"), "score"
    ))
    limits = written(liked.select(
        "a_block", "slot", "place", _divided(low, unit, up=True).alias("low"), _divided(high, unit, up=False).alias("high")
    ).where("low <= high"))
    hard = best_of(pairs.where("slice = 0"), pairs, limits, positives, negatives, False)
    return (
        hard.select("a_block", "slot", "place", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
        .join(liked.withColumnRenamed("score", "positive_score"), ["a_block", "slot", "place"])
        .join(slots, ["a_block", "slot"])
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )

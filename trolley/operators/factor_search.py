"""The items with the largest inner products for every user, exactly, without scoring every pair.

Items are dealt into cells of a few hundred: first by the length of their vectors
(shells, each holding about half of the items that are longer than its shortest), then by
the nearest of some directions that are drawn from the items. What a user can get from a
cell is at most the user's length times that of the longest vector of the cell, and at most the
product with the cell's centre plus the user's length times the cell's radius.

Users first meet the few cells that promise most. The ``k``-th score
found there is a limit that the ``k``-th best of all items reaches too, so
after that users meet only cells that may hold scores as high, and of these only such
scores are kept. The rows are those of scoring all pairs whatever the factors are; how many
cells a user meets depends on them. Users stay where they are, in packed portions, and the
tasks read the cells one after the other from the shared folder: what is written of a user and a
cell that it meets is the user's place in the portion. A task holds one portion, its lists and a few cells.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.sources.storage import discard, part_files, read_part, settled

CELL_ITEMS = 512
# Directions, at most. They are broadcast, as are the cells' centres.
MOST_DIRECTIONS = 16_384
# Users whose lists a task finds; each reads all cells. Users and cells that are compared at once.
PORTION_USERS = 65_536
STEP_USERS = 2048
STEP = 512
# Cells whose users are found before any are written, and cells that are read at once.
NEXT_CELLS = 64
# Scores found before a portion's lists are cut to their length.
HELD_SCORES = 1 << 20
# Multiplications that OpenBLAS does not share out among threads.
TILE = 1 << 18
# Cells that a user's first limit comes from: so many by the bound with this share of the radius.
FIRST_CELLS = ((1.0, 2), (0.5, 8))
# Single precision: scores and limits may be off by this share of the product of the lengths.
SLACK = 1e-5


@dataclass
class Cells:
    """The stored cells (ids, vectors), and in the order of its files per cell its size, centre, radius and longest vector."""

    table: DataFrame
    size: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    longest: np.ndarray


def _rows(values: pa.Array | pa.ChunkedArray, rank: int) -> np.ndarray:
    flat = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(-1, rank)


def item_cells(items: DataFrame, rank: int, cell_items: int = CELL_ITEMS) -> Cells:
    """The cells of the items (id, features)."""
    spark = items.sparkSession
    length = F.sqrt(F.aggregate("features", F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    known = items.select("id", "features", length.alias("length"))
    n_items = items.count()
    halvings = max(0, math.ceil(math.log2(max(1, n_items / cell_items))))
    edges = np.empty(0)
    if halvings:
        shares = [1 - 0.5**i for i in range(1, halvings + 1)]
        edges = np.array(known.agg(F.percentile_approx("length", shares, 100_000)).first()[0])
    # About one direction per cell.
    share = min(1 / cell_items, MOST_DIRECTIONS / max(n_items, 1))
    drawn = known.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < share * (1 << 20)).orderBy("id").toArrow()
    lengths = drawn["length"].to_numpy()
    directions = _rows(drawn["features"], rank) / np.maximum(lengths, 1e-30)[:, None].astype(np.float32)
    of_shell = [directions[np.searchsorted(edges, lengths) == s] for s in range(len(edges) + 1)]
    held = spark.sparkContext.broadcast((edges, of_shell))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges, of_shell = held.value
        for batch in batches:
            vectors, shell = _rows(batch["features"], rank), np.searchsorted(edges, batch["length"].to_numpy())
            nearest = np.zeros(len(shell), dtype=np.int32)
            for s in np.unique(shell):
                at = np.flatnonzero(shell == s)
                for part in np.array_split(at, len(at) // STEP + 1):
                    if len(of_shell[s]) and len(part):
                        nearest[part] = _products(vectors[part], of_shell[s]).argmax(1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shell.astype(np.int32)), pa.array(nearest), *batch.columns], ["shell", "nearest", *batch.schema.names]
            )

    dealt = known.mapInArrow(deal, "shell int, nearest int, id int, features array<float>, length double")
    order = ["shell", "nearest", "length", "id"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors = batch["id"].to_numpy().astype(np.int32), _rows(batch["features"], rank)
            shell, nearest = batch["shell"].to_numpy(), batch["nearest"].to_numpy()
            new = np.flatnonzero((np.diff(shell) != 0) | (np.diff(nearest) != 0)) + 1
            ends = [0, *new.tolist(), len(ids)]
            starts = [at for a, b in zip(ends, ends[1:]) for at in range(a, b, cell_items)]
            cells = []
            for a, b in zip(starts, [*starts[1:], len(ids)]):
                own = vectors[a:b]
                centre = own.mean(0)
                radius = np.sqrt(((own - centre).astype(np.float64) ** 2).sum(1).max())
                longest = np.sqrt((own.astype(np.float64) ** 2).sum(1).max())
                cells.append((ids[a:b].tobytes(), own.tobytes(), b - a, centre.tobytes(), radius, longest))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(values, kind)
                    for values, kind in zip(
                        list(zip(*cells)) or [[]] * 6, (pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.float64(), pa.float64())
                    )
                ],
                ["ids", "vectors", "size", "centre", "radius", "longest"],
            )

    parts = max(1, min(n_items // (8 * cell_items), 4 * spark.sparkContext.defaultParallelism))
    sorted_items = dealt.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    kinds = "ids binary, vectors binary, size int, centre binary, radius double, longest double"
    table = settled(sorted_items.mapInArrow(cut, kinds).withColumn("cell", F.monotonically_increasing_id()), "item-cells")
    known_cells = table.select("cell", "size", "centre", "radius", "longest").toArrow().sort_by("cell")
    centre = np.frombuffer(b"".join(known_cells["centre"].to_pylist()), dtype=np.float32).reshape(-1, rank)
    size, radius, longest = (known_cells[c].to_numpy() for c in ("size", "radius", "longest"))
    return Cells(table.select("ids", "vectors"), size, centre, radius.astype(np.float32), longest.astype(np.float32))


def _portions(users: DataFrame, parts: int) -> DataFrame:
    """(ids, vectors): a row and a file per portion."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = [], []
        for batch in batches:
            ids.append(batch["id"].to_numpy().astype(np.int32).tobytes())
            vectors.append(batch["features"].flatten().to_numpy(zero_copy_only=False).astype(np.float32).tobytes())
        packed = [pa.array([b"".join(c)], pa.binary()) for c in (ids, vectors)]
        yield pa.RecordBatch.from_arrays(packed, ["ids", "vectors"])

    dealt = users.select("id", "features").repartition(parts, "id")
    return settled(dealt.mapInArrow(pack, "ids binary, vectors binary"), "user-portions")


def _packed(file: str, rank: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, vectors) of the rows of a file of portions or cells."""
    for batch in read_part(file, "ids", "vectors", rows=NEXT_CELLS):
        for ids, vectors in zip(batch["ids"], batch["vectors"]):
            yield np.frombuffer(ids.as_buffer(), dtype=np.int32), np.frombuffer(vectors.as_buffer(), dtype=np.float32).reshape(-1, rank)


def _first_cells(vectors, cells, k):
    """Per user the cells with the highest bounds and halfway to them, of those that hold ``k`` items if any do."""
    size, centre, radius, longest = cells
    able = np.flatnonzero(size >= min(k, size.max()))
    lengths, met = _lengths(vectors), []
    for share, n in FIRST_CELLS:
        best, at = [], []
        for start in range(0, len(able), STEP):
            part = able[start : start + STEP]
            bounds = _bounds(vectors, lengths, centre[part], share * radius[part], longest[part])
            for _ in range(min(n, len(part))):
                top = bounds.argmax(1)
                best.append(bounds[np.arange(len(top)), top])
                at.append(part[top])
                bounds[np.arange(len(top)), top] = -np.inf
        order = np.argsort(-np.stack(best, axis=1), axis=1, kind="stable")[:, :n]
        met.append(np.take_along_axis(np.stack(at, axis=1), order, 1))
    met = np.sort(np.concatenate(met, axis=1), axis=1)
    # A cell that is met twice would count its scores twice.
    who, place = np.nonzero(np.c_[np.ones(len(met), dtype=bool), met[:, 1:] != met[:, :-1]])
    return who, met[who, place]


def _able_cells(vectors, limits, cells):
    """(cell, users) in the order of the cells: the users that may have a score there that reaches their limit."""
    size, centre, radius, longest = cells
    lengths = _lengths(vectors)
    for first in range(0, len(size), NEXT_CELLS):
        part, met = slice(first, first + NEXT_CELLS), []
        for start in range(0, len(vectors), STEP_USERS):
            own = slice(start, start + STEP_USERS)
            bounds = _bounds(vectors[own], lengths[own], centre[part], radius[part], longest[part])
            who, what = np.nonzero(bounds >= limits[own, None])
            met.append((who.astype(np.int32) + start, what))
        who, what = (np.concatenate(c) for c in zip(*met))
        order = np.argsort(what, kind="stable")
        for cell, group in _groups(who[order], what[order]):
            yield first + cell, group


def _groups(who: np.ndarray, what: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The parts of ``who`` that share a value of ``what``, which is sorted."""
    starts = np.flatnonzero(np.r_[True, what[1:] != what[:-1]]).tolist() if len(what) else []
    for a, b in zip(starts, [*starts[1:], len(what)]):
        yield int(what[a]), who[a:b]


def _lengths(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors.astype(np.float64) ** 2).sum(1)).astype(np.float32)


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """``left @ right.T`` in tiles that BLAS works out in one thread: all tasks of an executor do this at once."""
    out = np.empty((len(left), len(right)), dtype=np.float32)
    step, across = max(1, TILE // max(1, right.size)), right.T
    for start in range(0, len(left), step):
        np.matmul(left[start : start + step], across, out=out[start : start + step])
    return out


def _summed_in_order(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The products of rows, added up factor by factor, so that a score does not depend on what it was worked out beside."""
    total = np.zeros(len(left), dtype=np.float32)
    for a, b in zip(left.T, right.T):
        total = (total + a.astype(np.float64) * b).astype(np.float32)
    return total


def _bounds(vectors, lengths, centre, radius, longest) -> np.ndarray:
    """The most that each user's score with an item of each cell can be, up to ``SLACK``."""
    bounds = _products(vectors, centre)
    bounds += lengths[:, None] * radius
    return np.minimum(bounds, lengths[:, None] * longest, out=bounds)


class _Lists:
    """The best items of the users of a portion among those met so far."""

    def __init__(self, vectors: np.ndarray, limits: np.ndarray, longest: float, k: int):
        self.vectors, self.limits, self.k = vectors, limits.copy(), k
        # A product that reaches a score in the order of the factors may be lower by this as BLAS works it out.
        self.slack = _lengths(vectors) * np.float32(SLACK * longest)
        self.held, self.n = [], 0

    def meet(self, users: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Score these users with the items of a cell; of the scores that reach a user's limit the ``k`` best are held."""
        k = self.k
        for start in range(0, len(users), STEP_USERS):
            own = users[start : start + STEP_USERS]
            mine, least = self.vectors[own], self.limits[own]
            scores = _products(mine, vectors)
            if len(ids) > k and np.isneginf(least).any():
                reached = np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k]
                least = np.maximum(least, reached - SLACK * np.abs(scores).max(1))
            who, what = np.nonzero(scores >= least[:, None])
            found = _summed_in_order(mine[who], vectors[what])
            if len(who) and np.bincount(who).max() > k:
                who, item, found, _ = _best(who, ids[what], found, len(own), k)
            else:
                item = ids[what]
            if len(who):
                self.held.append((own[who], item, found))
                self.n += len(who)
        if self.n > max(HELD_SCORES, 4 * k * len(self.vectors)):
            self.cut()

    def cut(self) -> tuple[np.ndarray, ...]:
        """(user, item, score, place) of the ``k`` best so far; who has so many is held to the last of them from now on."""
        none = np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0, np.float32)
        who, item, score, place = _best(*(np.concatenate(c) for c in zip(none, *self.held)), len(self.vectors), self.k)
        last = place == self.k
        self.limits[who[last]] = np.maximum(self.limits[who[last]], score[last] - self.slack[who[last]])
        self.held, self.n = [(who, item, score)], len(who)
        return who, item, score, place


def _best(who: np.ndarray, item: np.ndarray, score: np.ndarray, n: int, k: int) -> tuple[np.ndarray, ...]:
    """(who, item, score, place) of the ``k`` best of each of ``n`` users, in order."""
    order = np.lexsort((item, -score, who))
    place = np.arange(len(order)) - np.searchsorted(who[order], np.arange(n))[who[order]] + 1
    order, place = order[place <= k], place[place <= k]
    return who[order], item[order], score[order], place.astype(np.int32)


def _sent(portions: DataFrame, cells: Cells, rank: int, k: int) -> DataFrame:
    """(portion, cell, users, limits): for every portion a row with the limits of its users, then, in order, the cells they meet.

    ``users`` are places in the portion.
    """
    spark, files, cell_files = portions.sparkSession, part_files(portions), part_files(cells.table)
    held = spark.sparkContext.broadcast((cells.size, cells.centre, cells.radius, cells.longest))

    def first_limits(vectors: np.ndarray) -> np.ndarray:
        lists = _Lists(vectors, np.full(len(vectors), -np.inf, dtype=np.float32), float(held.value[3].max()), k)
        met = [
            (who + start, what)
            for start in range(0, len(vectors), STEP_USERS)
            for who, what in [_first_cells(vectors[start : start + STEP_USERS], held.value, k)]
        ]
        who, what = (np.concatenate(c) for c in zip(*met))
        order = np.argsort(what, kind="stable")
        _meet_all(lists, _groups(who[order], what[order]), cell_files, rank)
        lists.cut()
        return lists.limits

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for portion in (p for batch in batches for p in batch["id"].to_pylist()):
            ((_, vectors),) = _packed(files[portion], rank)
            limits = first_limits(vectors) if len(vectors) else np.empty(0, dtype=np.float32)
            yield packed(portion, [(-1, b"", limits.tobytes())])
            rows = []
            for cell, users in _able_cells(vectors, limits, held.value) if len(vectors) else ():
                rows.append((cell, users.tobytes(), None))
                if len(rows) == NEXT_CELLS:
                    yield packed(portion, rows)
                    rows = []
            if rows:
                yield packed(portion, rows)

    def packed(portion: int, rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))]
        return pa.RecordBatch.from_arrays([pa.array([portion] * len(rows), pa.int32()), *columns], ["portion", "cell", "users", "limits"])

    numbers = spark.range(0, len(files), 1, len(files))
    return numbers.mapInArrow(send, "portion int, cell int, users binary, limits binary")


def _meet_all(lists: _Lists, met: Iterator[tuple[int, np.ndarray]], cell_files: list[str], rank: int) -> None:
    """Let the users meet the cells, both in the order of the cells' files."""
    following = next(met, None)
    cells = (cell for file in cell_files for cell in _packed(file, rank))
    for number, (ids, vectors) in enumerate(cells):
        if following is None:
            return
        if following[0] == number:
            lists.meet(following[1], ids, vectors)
            following = next(met, None)


def _ranked(portions: DataFrame, sent: DataFrame, cells: Cells, rank: int, k: int) -> DataFrame:
    """(user, place, item, score): the ``k`` best of the scores of the users in the cells that they meet."""
    spark, files, sent_files, cell_files = portions.sparkSession, part_files(portions), part_files(sent), part_files(cells.table)
    longest = float(cells.longest.max())
    if len(sent_files) != len(files):
        raise ValueError("a portion has no file")

    def rank_portion(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for portion in (p for batch in batches for p in batch["id"].to_pylist()):
            ((own, vectors),) = _packed(files[portion], rank)
            rows = (
                row
                for batch in read_part(sent_files[portion], "portion", "cell", "users", "limits", rows=NEXT_CELLS)
                for row in zip(*(batch[c] for c in ("portion", "cell", "users", "limits")))
            )
            of, _, _, limits = next(rows)
            if of.as_py() != portion:
                raise ValueError("the users of another portion")
            lists = _Lists(vectors, np.frombuffer(limits.as_buffer(), dtype=np.float32), longest, k)
            met = ((cell.as_py(), np.frombuffer(users.as_buffer(), dtype=np.int32)) for _, cell, users, _ in rows)
            _meet_all(lists, met, cell_files, rank)
            who, item, score, place = lists.cut()
            for at in range(0, len(who), STEP_USERS * k):
                part = slice(at, at + STEP_USERS * k)
                columns = [pa.array(c) for c in (own[who[part]], place[part], item[part], score[part])]
                yield pa.RecordBatch.from_arrays(columns, ["user", "place", "item", "score"])

    return spark.range(0, len(files), 1, len(files)).mapInArrow(rank_portion, "user int, place int, item int, score float")


def best_items(users: DataFrame, items: DataFrame, rank: int, k: int, cell_items: int = CELL_ITEMS) -> DataFrame:
    """(user, place, item, score): the ``k`` items with the largest products per user; ties go to the smaller item.

    ``users`` and ``items`` are (id, features), ids being ints and unique. Users get all
    items where there are fewer than ``k``.
    """
    spark = users.sparkSession
    if users.isEmpty() or items.isEmpty():
        no_score = F.lit(float("-inf")).cast("float")
        return users.select(F.col("id").alias("user"), F.lit(1).alias("place"), F.lit(0).alias("item"), no_score.alias("score")).limit(0)
    cells = item_cells(items, rank, cell_items)
    portions = _portions(users, max(2 * spark.sparkContext.defaultParallelism, users.count() // PORTION_USERS))
    sent = settled(_sent(portions, cells, rank, k), "sent-users")
    best = settled(_ranked(portions, sent, cells, rank, k), "best-items")
    discard(portions, sent, cells.table)
    return best

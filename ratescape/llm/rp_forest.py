"""Nearest neighbours by inner product: a forest of random-projection trees.

Every tree halves a bounded sample (``sample`` rows, those of smallest hash) at the
median of a random projection, the best-spread of a few differences of two sample
points. Vectors get one more component that gives all the same length, so that the
nearest points are those of largest inner product. All rows of the table go down
every tree into its leaves.

A query walks all trees through one priority queue: the branch whose cuts it
misses by least (sum of squared distances to the planes) comes first. How deep the
trees are used and how many leaves a query visits is set by a measurement: for a
bounded number of calibration queries the exact neighbours among all rows are
found, and the smallest budget that reaches ``recall`` of them is taken. On data
without structure that is much of the table; on clustered data little.

Leaf candidates are scored exactly and a pair of rows only in the first tree that
brings it together. A leaf is cut into blocks of ``BLOCK_ROWS`` vectors and each block's
queries are dealt to as many tasks as their expected number needs, so neither a
leaf with a third of all rows nor one that all queries visit is one task.

Equal vectors are searched once: a class of them has one row in the index, with the
``k`` + 1 smallest ids, which is as many as a query can need.

Null, zero and non-finite vectors take no part, nor vectors of another length than
most have (of equally many, the longest). Rows with equal ids are rows of their own. Other
columns are not read. No rows give no rows.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratescape.llm.common import stored, tidy

TREES, SAMPLE, RECALL, CALIBRATION = 2, 16_384, 0.95, 256
#: A tree is no deeper than its sample and the table fill.
LEAF_SAMPLE, LEAF_ROWS = 16, 64
#: Directions tried for a cut.
TRIES = 16
BLOCK_ROWS, TASK_QUERIES, SCORED = 16_384, 50_000, 256
#: For the choice of depth: inner products and bytes moved per second and core.
FLOPS, MOVED = 1e10, 3e7
#: Rows of a class that one task joins with their queries.
COPIES = 10_000


# ---------------------------------------------------------------- the forest


@dataclass(frozen=True)
class Forest:
    """Complete binary trees in heap order: node i has the children 2i + 1 and 2i + 2."""

    planes: np.ndarray  # trees x nodes x (dimensions + 1)
    cuts: np.ndarray  # trees x nodes
    depth: int
    scale: float  # 1 / largest absolute component
    length: float  # common length of the scaled, lengthened vectors

    def lengthened(self, vectors: np.ndarray) -> np.ndarray:
        scaled = vectors * self.scale
        rest = np.sqrt(np.maximum(self.length**2 - np.einsum("ij,ij->i", scaled, scaled), 0.0))
        return np.concatenate([scaled, rest[:, None]], axis=1)

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of every vector in every tree, as rows x trees."""
        points = self.lengthened(vectors)
        out = np.zeros((len(points), len(self.planes)), np.int64)
        for t in range(len(self.planes)):
            node = np.zeros(len(points), np.int64)
            for _ in range(self.depth):
                side = np.einsum("ij,ij->i", points, self.planes[t, node]) >= self.cuts[t, node]
                node = 2 * node + 1 + side
            out[:, t] = node - (2**self.depth - 1)
        return out

    def margins(self, queries: np.ndarray) -> np.ndarray:
        """Signed distances of queries to all planes: rows x trees x nodes."""
        norm = np.linalg.norm(queries, axis=1, keepdims=True)
        points = queries / norm * self.length
        return np.einsum("qd,tnd->qtn", points, self.planes[:, :, :-1], optimize=True) - self.cuts

    def at_depth(self, depth: int) -> Forest:
        """The same trees, cut off."""
        nodes = 2**depth - 1
        return Forest(self.planes[:, :nodes], self.cuts[:, :nodes], depth, self.scale, self.length)


def visit(margins: np.ndarray, depth: int, budget: int, sizes: np.ndarray | None = None, least: int = 0) -> list[tuple[int, int]]:
    """The first ``budget`` leaves (tree, leaf) of a query, through one queue over all trees.

    With the ``sizes`` of leaves, it goes on until one tree's have ``least`` rows.
    """
    first_leaf = 2**depth - 1
    queue = [(0.0, tree, 0) for tree in range(len(margins))]
    found = []
    rows = [0] * len(margins)
    while queue and (len(found) < budget or sizes is not None and max(rows) < least):
        missed, tree, node = heapq.heappop(queue)
        while node < first_leaf:
            margin = margins[tree, node]
            near = 2 * node + 1 + (margin >= 0)
            heapq.heappush(queue, (missed + margin * margin, tree, 4 * node + 3 - near))
            node = near
        leaf = int(node) - first_leaf
        found.append((tree, leaf))
        rows[tree] += 0 if sizes is None else int(sizes[tree, leaf])
    return found


def grow(sample: np.ndarray, trees: int, depth: int, scale: float, length: float, seed: int) -> Forest:
    rng = np.random.default_rng(seed)
    blank = Forest(np.zeros((trees, 2**depth - 1, sample.shape[1] + 1)), np.zeros((trees, 2**depth - 1)), depth, scale, length)
    points = blank.lengthened(sample)
    for t in range(trees):
        rows = {0: np.arange(len(points))}
        for node in range(2**depth - 1):
            mine = rows.pop(node)
            pairs = rng.integers(0, max(1, len(mine)), (TRIES, 2))
            ways = points[mine[pairs[:, 0]]] - points[mine[pairs[:, 1]]] if len(mine) else np.zeros((TRIES, points.shape[1]))
            flat = np.linalg.norm(ways, axis=1) == 0
            ways[flat] = rng.normal(size=(int(flat.sum()), points.shape[1]))
            ways /= np.linalg.norm(ways, axis=1, keepdims=True)
            along = points[mine] @ ways.T
            best = int(along.std(axis=0).argmax()) if len(mine) else 0
            cut = float(np.median(along[:, best])) if len(mine) else 0.0
            blank.planes[t, node], blank.cuts[t, node] = ways[best], cut
            side = along[:, best] >= cut
            rows[2 * node + 1], rows[2 * node + 2] = mine[~side], mine[side]
    return blank


# ---------------------------------------------------------------- the table


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def valid(table: DataFrame, row_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, v, h, copies): rows that take part; copies is the number of rows whose vector has the same hash h."""
    v = F.col("v")
    whole = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = table.select(F.col(f"`{row_id}`").cast("long").alias("id"), F.col(f"`{vector}`").alias("v"))
    rows = rows.where(whole & F.exists(v, lambda x: x != 0))
    most = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    rows = rows.where(F.size("v") == (most["n"] if most else 0)).withColumn("h", F.xxhash64("v"))
    repeated = stored(rows.groupBy("h").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1"), "forest-repeated")
    return rows.join(repeated, "h", "left").select("id", "v", "h", F.coalesce("copies", F.lit(1).cast("long")).alias("copies"))


def _classed(rows: DataFrame) -> DataFrame:
    """Rows with their class: equal vectors share one, a hash that no other row has names its own."""
    same = F.concat(F.lit("="), F.sha2(F.col("v").cast("string"), 256))
    return rows.withColumn("class", F.when(F.col("copies") > 1, same).otherwise(F.col("h").cast("string")))


def _classes(rows: DataFrame, k: int) -> DataFrame:
    """(class, v, ids): one row per class, with its k + 1 smallest ids."""
    alone = rows.where("copies = 1").select("class", "v", F.array("id").alias("ids"))
    place = F.row_number().over(Window.partitionBy("class").orderBy(F.col("id").asc_nulls_last()))
    firsts = rows.where("copies > 1").withColumn("place", place).where(F.col("place") <= k + 1)
    grouped = firsts.groupBy("class").agg(F.first("v").alias("v"), F.array_sort(F.collect_list("id")).alias("ids"))
    return alone.unionByName(grouped)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best, ties to smaller ids."""
    if len(scores) > 4 * k:
        kept = np.flatnonzero(scores >= -np.partition(-scores, k - 1)[k - 1])
    else:
        kept = np.arange(len(scores))
    return kept[np.lexsort((ids[kept], -scores[kept]))[:k]]


def _exact(queries: np.ndarray, k: int):
    """Per batch of classes, the k best classes of every calibration query, with their vectors."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _vectors(batch.column("v"))
            scores = queries @ v.T
            at = np.argpartition(-scores, min(k, len(v)) - 1, axis=1)[:, : min(k, len(v))]
            of, place = np.repeat(np.arange(len(queries)), at.shape[1]), at.ravel()
            picked = batch.column("v").take(pa.array(place))
            yield pa.RecordBatch.from_arrays([pa.array(of.astype(np.int32)), pa.array(scores[of, place]), picked], ["q", "score", "v"])

    return tidy(run)


@dataclass(frozen=True)
class Plan:
    """A forest with what a query visits of it; ``seen`` is the share of calibration queries at each tree's leaf."""

    forest: Forest
    budget: int
    seen: np.ndarray
    recall: float


def calibrate(forest: Forest, queries: np.ndarray, near: list[np.ndarray], n: int, recall: float) -> Plan:
    """The depth and budget of least cost that find ``recall`` of the neighbours of the calibration queries.

    ``near[i]`` has the vectors of query i's true neighbours.
    """
    best = None
    everything = forest.margins(queries)
    wanted = sum(map(len, near))
    for depth in range(forest.depth + 1):
        cut = forest.at_depth(depth)
        orders = [visit(m[:, : 2**depth - 1], depth, len(m) * 2**depth) for m in everything]
        needed = []
        for order, vectors in zip(orders, near, strict=True):
            rank = {leaf: i for i, leaf in enumerate(order)}
            for row in cut.leaves(vectors):
                needed.append(min(rank[t, leaf] for t, leaf in enumerate(row.tolist())))
        needed.sort()
        budget = needed[max(0, int(np.ceil(recall * wanted)) - 1)] + 1
        width = 8 * queries.shape[1]
        cost = budget * (2 * n / 2**depth * queries.shape[1] / FLOPS + width / MOVED)
        if best is None or cost < best[0]:
            seen = np.zeros((len(forest.planes), 2**depth))
            for order in orders:
                for t, leaf in order[:budget]:
                    seen[t, leaf] += 1 / len(orders)
            best = cost, Plan(cut, budget, seen, sum(x < budget for x in needed) / max(1, wanted))
    return best[1]


# ---------------------------------------------------------------- the search

_CELL = "cell int, block int, deal int, kind int"
_ROW = f"{_CELL}, class string, v array<double>, ids array<bigint>, leaves array<int>"


def _deals(seen: np.ndarray, queries: int) -> np.ndarray:
    """Tasks per block of each leaf, by the queries to be expected there."""
    return np.floor(seen * queries / TASK_QUERIES).astype(np.int64) + 1


def _mixed(names: list[str], n: int) -> np.ndarray:
    """A fixed number below n for every name."""
    import zlib

    return np.array([zlib.crc32(x.encode()) for x in names], np.int64) % n


def _rows_of(cells, blocks, deals, kind, names, v, ids, leaves):
    arrays = [pa.array(np.asarray(x, np.int32)) for x in (cells, blocks, deals, np.full(len(cells), kind))]
    return pa.RecordBatch.from_arrays([*arrays, names, v, ids, leaves], ["cell", "block", "deal", "kind", "class", "v", "ids", "leaves"])


def _planted(plan, blocks: np.ndarray, deals: np.ndarray):
    """Classes, once per tree, block task: kind 0."""

    def run(batches):
        forest = plan.value.forest
        width = 2**forest.depth
        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.column("class").to_pylist()
            leaves = forest.leaves(_vectors(batch.column("v")))
            hashed = _mixed(names, 1 << 31)
            offsets = pa.array(np.arange(0, leaves.size + 1, leaves.shape[1], dtype=np.int32))
            lists = pa.ListArray.from_arrays(offsets, pa.array(leaves.astype(np.int32).ravel()))
            for t in range(leaves.shape[1]):
                leaf = leaves[:, t]
                times = deals[t, leaf]
                at = np.repeat(np.arange(len(leaf)), times)
                deal = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
                block = (hashed % blocks[t, leaf])[at]
                take = pa.array(at)
                yield _rows_of((t * width + leaf)[at], block, deal, 0, *(c.take(take) for c in (batch.column("class"), batch.column("v"), batch.column("ids"), lists)))

    return tidy(run)


def _requests(plan, sizes: np.ndarray, least: int, blocks: np.ndarray, deals: np.ndarray):
    """Query classes, once per block of the leaves that they visit: kind 1; ``leaves`` has all cells visited."""

    def run(batches):
        forest, budget = plan.value.forest, plan.value.budget
        width = 2**forest.depth
        for whole in batches:
            for first in range(0, whole.num_rows, SCORED):
                batch = whole.slice(first, SCORED)
                margins = forest.margins(_vectors(batch.column("v")))
                hashed = _mixed(batch.column("class").to_pylist(), 1 << 31)
                at, cells, of_block, of_deal, lists = [], [], [], [], []
                for i, m in enumerate(margins):
                    order = visit(m, forest.depth, budget, sizes, least)
                    lists.append([t * width + leaf for t, leaf in order])
                    for t, leaf in order:
                        for block in range(blocks[t, leaf]):
                            at.append(i), cells.append(t * width + leaf), of_block.append(block), of_deal.append(hashed[i] % deals[t, leaf])
                take = pa.array(at, pa.int64())
                visited = pa.array(lists, pa.list_(pa.int32()))
                nothing = pa.nulls(len(at), pa.list_(pa.int64()))
                yield _rows_of(cells, of_block, of_deal, 1, batch.column("class").take(take), batch.column("v").take(take), nothing, visited.take(take))

    return tidy(run)


_FOUND = "query string, other string, score double, ids array<bigint>"


def _scored(k: int, width: int, trees: int):
    """Cells in a row, vectors before requests: every request's best rows of its block."""

    def run(batches):
        cell, rows = None, []
        v = leaves = names = ids = None

        def score(part: pa.RecordBatch):
            q = _vectors(part.column("v"))
            visited = np.zeros((len(q), trees * width), bool)
            lists = part.column("leaves")
            visited[np.repeat(np.arange(len(q)), np.diff(lists.offsets.to_numpy())), lists.flatten().to_numpy()] = True
            scores = q @ v.T
            for t in range(cell[0] // width):  # an earlier tree has brought them together
                scores[visited[:, t * width + leaves[:, t]]] = -np.inf
            of, at = [], []
            for i, row in enumerate(scores):
                # rounding differs between products of matrices and of vectors
                low = -np.partition(-row, k)[k] if len(row) > k + 1 else -np.inf
                near = np.flatnonzero((row >= low - 1e-9 * abs(low)) & (row > -np.inf)) if low > -np.inf else np.flatnonzero(row > -np.inf)
                of.append(np.full(len(near), i)), at.append(near)
            of, at = np.concatenate(of), np.concatenate(at)
            exact = np.einsum("ij,ij->i", q[of], v[at])
            return pa.RecordBatch.from_arrays([part.column("class").take(pa.array(of)), names.take(pa.array(at)), pa.array(exact), ids.take(pa.array(at))], ["query", "other", "score", "ids"])

        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(c).to_numpy() for c in ("cell", "block", "deal", "kind")], axis=1)
            edges = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), len(key)]
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                here, kind = tuple(key[low, :3].tolist()), key[low, 3]
                part = batch.slice(low, high - low)
                if here != cell:
                    cell, rows, v = here, [], None
                if kind == 0:
                    rows.append(part)
                    continue
                if not rows and v is None:
                    continue  # a leaf without vectors
                if v is None:
                    table = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
                    v, names, ids = _vectors(table.column("v")), table.column("class"), table.column("ids")
                    leaves, rows = _vectors(table.column("leaves")).astype(np.int64), []
                for first in range(0, part.num_rows, SCORED):
                    yield score(part.slice(first, SCORED))

    return tidy(run)


def plan_search(classes: DataFrame, query_classes: DataFrame, k: int, trees: int = TREES, sample: int = SAMPLE, recall: float = RECALL, seed: int = 11) -> Plan | None:
    """A forest grown on a sample and the budget measured on calibration queries; None without rows."""
    state = classes.agg(F.count(F.lit(1)), F.max(F.array_max(F.transform("v", F.abs)))).first()
    n, largest = state
    if not n:
        return None
    scale = 1 / float(largest)
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + (x * scale) * (x * scale))
    length = float(np.sqrt(classes.agg(F.max(squares)).first()[0])) * (1 + 1e-12)
    by_hash = [F.xxhash64(F.lit(seed), "class"), "class"]
    picked = np.array([r.v for r in classes.select("v", "class").orderBy(*by_hash).limit(sample).collect()], np.float64)
    depth = max(0, int(np.log2(max(1, min(len(picked) / LEAF_SAMPLE, n / LEAF_ROWS)))))
    forest = grow(picked, trees, depth, scale, length, seed)
    asked = np.array([r.v for r in query_classes.select("v", "class").orderBy(*by_hash).limit(CALIBRATION).collect()], np.float64)
    if not len(asked):
        return Plan(forest.at_depth(0), 1, np.ones((trees, 1)), 1.0)
    near = classes.select("v").mapInArrow(_exact(asked, k + 1), "q int, score double, v array<double>")
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score")))
    true: list[list] = [[] for _ in asked]
    for r in near.withColumn("place", place).where(F.col("place") <= k + 1).select("q", "v").collect():
        true[r.q].append(r.v)
    return calibrate(forest, asked, [np.array(x, np.float64) for x in true], n, recall)


def nearest(table: DataFrame, every: int = 20, k: int = 20, row_id: str = "vec_id", vector: str = "embedding", **options) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest rows found of each row whose id ``every`` divides."""
    spark = table.sparkSession
    rows = _classed(valid(table, row_id, vector).withColumn("v", F.col("v").cast("array<double>")))
    out = "query_id long, rank int, vec_id long, score double"
    classes = stored(_classes(rows, k), "forest-classes")
    asking = rows.where(F.col("id") % every == 0)
    alone = asking.where("copies = 1").select("class", "v")
    queries = stored(alone.union(asking.where("copies > 1").groupBy("class").agg(F.first("v").alias("v"))), "forest-queries")
    plan = plan_search(classes, queries, k, **options)
    if plan is None:
        return spark.createDataFrame([], out)
    forest, width = plan.forest, 2**plan.forest.depth
    trees = len(forest.planes)
    shared = spark.sparkContext.broadcast(plan)

    def leaf_counts(batches):
        grown = shared.value.forest
        total = np.zeros((trees, width), np.int64)
        for batch in batches:
            if batch.num_rows:
                for t, leaf in enumerate(grown.leaves(_vectors(batch.column("v"))).T):
                    total[t] += np.bincount(leaf, minlength=width)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(trees * width, dtype=np.int32)), pa.array(total.ravel())], ["cell", "rows"])

    counted = classes.select("v").mapInArrow(tidy(leaf_counts), "cell int, rows bigint").groupBy("cell").agg(F.sum("rows").alias("rows"))
    sizes = np.zeros(trees * width, np.int64)
    for r in counted.collect():  # one row per leaf of the forest, whose size the sample bounds
        sizes[r.cell] = r.rows
    sizes = sizes.reshape(trees, width)
    blocks = sizes // BLOCK_ROWS + 1
    deals = _deals(plan.seen, queries.count())
    planted = classes.mapInArrow(_planted(shared, blocks, deals), _ROW)
    requests = queries.mapInArrow(_requests(shared, sizes, k + 1, blocks, deals), _ROW)
    met = planted.union(requests).repartition("cell", "block", "deal").sortWithinPartitions("cell", "block", "deal", "kind")
    found = met.mapInArrow(_scored(k, width, trees), _FOUND)

    # k + 1 rows hold the k nearest besides the query's own; of the own class, one row with the own id goes
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last()))
    each = found.select("query", "score", (F.col("query") == F.col("other")).alias("own"), F.explode("ids").alias("vec_id"))
    kept = each.withColumn("place", place).where(F.col("place") <= k + 1)
    hit = F.struct("place", "score", "vec_id", "own")
    lists = kept.groupBy("query").agg(F.array_sort(F.collect_list(hit)).alias("hits"))
    salts = F.floor(F.col("copies") / COPIES).cast("int")
    sized = rows.where("copies > 1").groupBy("class").agg(F.first("copies").alias("copies"))
    lists = lists.join(sized, lists["query"] == sized["class"], "left").select("query", "hits", F.explode(F.sequence(F.lit(0), F.coalesce(salts, F.lit(0)))).alias("salt"))
    ids = asking.select("id", "class", F.pmod(F.xxhash64("id"), salts + 1).cast("int").alias("salt"))
    joined = ids.join(lists, (ids["class"] == lists["query"]) & (ids["salt"] == lists["salt"])).select("id", "hits")
    own = F.expr("coalesce(array_min(transform(filter(hits, h -> h.own AND h.vec_id <=> id), h -> h.place)), -1)")
    others = joined.withColumn("own_place", own).withColumn("others", F.expr(f"slice(filter(hits, h -> h.place != own_place), 1, {k})"))
    ranked = others.select(F.col("id").alias("query_id"), F.posexplode("others").alias("rank", "h"))
    return ranked.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("h.vec_id").alias("vec_id"), F.col("h.score").alias("score"))

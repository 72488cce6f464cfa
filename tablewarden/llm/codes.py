"""Vector code compression: parts of vectors coded by codebooks that metric trees of the parts refine."""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.llm.common import query, read, settled
from tablewarden.operators.attach import attach

SCALE = 256  # fixed value: steps of a unit
PARTS, ENTRIES, ROUNDS = 16, 64, 2
BLOCK = 4096  # vectors whose trees are built together
LEAF = 32  # points of a ball that is not cut any more
SLACK = 1 + 1e-9  # distances of balls are rounded; an entry is ruled out only beyond this
POINTS = 1 << 14  # points of leaves compared at once


# --- trees -------------------------------------------------------------------------------
@dataclass
class Balls:
    """Balls over the points of one part: ranges of ``order`` with cached sums; children are -1 for leaves."""

    order: np.ndarray
    first: np.ndarray
    last: np.ndarray
    left: np.ndarray
    right: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    sums: np.ndarray


def anchors(points: np.ndarray, many: int) -> list[np.ndarray]:
    """Groups of points around at most ``many`` anchors, each at the anchor nearest to it.

    A new anchor is the point farthest from its own; it can only win points that lie more than half the distance of
    the two anchors from their present one.
    """
    far = ((points - points[0]) ** 2).sum(1)
    owner, pivots = np.zeros(len(points), np.int64), [0]
    while len(pivots) < many:
        new = int(far.argmax())
        if far[new] == 0:
            break
        between = ((points[pivots] - points[new]) ** 2).sum(1)
        maybe = np.flatnonzero(4 * far > between[owner])
        reach = ((points[maybe] - points[new]) ** 2).sum(1)
        won = reach < far[maybe]
        owner[maybe[won]], far[maybe[won]] = len(pivots), reach[won]
        pivots.append(new)
    return [g for g in (np.flatnonzero(owner == k) for k in range(len(pivots))) if len(g)]


class Builder:
    """Middle-out: anchors about the square root of the points, merged upwards pair by pair, cut again downwards."""

    def __init__(self, points: np.ndarray):
        self.points = points.astype(np.float64)
        self.children: list[tuple[int, int]] = []
        self.members: list[np.ndarray | None] = []
        self.root = self.cut(np.arange(len(points)))

    def leaf(self, own: np.ndarray) -> int:
        self.children.append((-1, -1))
        self.members.append(own)
        return len(self.members) - 1

    def cut(self, own: np.ndarray) -> int:
        if len(own) <= LEAF:
            return self.leaf(own)
        groups = anchors(self.points[own], max(2, isqrt(len(own))))
        if len(groups) == 1:
            return self.leaf(own)
        return self.merged([own[g] for g in groups])

    def merged(self, groups: list[np.ndarray]) -> int:
        """The ball of all groups: again and again, the two whose common ball is smallest become one."""
        centre = np.stack([self.points[g].mean(0) for g in groups])
        radius = np.array([np.sqrt(((self.points[g] - c) ** 2).sum(1).max()) for g, c in zip(groups, centre, strict=True)])
        size = np.array([len(g) for g in groups], float)
        ball = [self.cut(g) for g in groups]
        apart = np.sqrt(((centre[:, None] - centre) ** 2).sum(2))
        common = np.maximum((apart + radius[:, None] + radius) / 2, np.maximum(radius[:, None], radius))
        np.fill_diagonal(common, np.inf)
        for _ in range(len(groups) - 1):
            a, b = divmod(int(common.argmin()), len(groups))
            reach = common[a, b]
            self.children.append((ball[a], ball[b]))
            self.members.append(None)
            ball[a] = len(self.members) - 1
            centre[a] = (size[a] * centre[a] + size[b] * centre[b]) / (size[a] + size[b])
            size[a] += size[b]
            radius[a] = reach
            common[b] = common[:, b] = np.inf
            left = np.isfinite(common[a])
            apart = np.sqrt(((centre[left] - centre[a]) ** 2).sum(1))
            common[a, left] = common[left, a] = np.maximum((apart + reach + radius[left]) / 2, np.maximum(reach, radius[left]))
        return ball[a] if len(groups) > 1 else ball[0]

    def balls(self, points: np.ndarray) -> Balls:
        """Nodes from the root downwards, with ranges, sums, centres and radii over the points in the order of the leaves."""
        many = len(self.members)
        first, last, order = np.zeros(many, np.int64), np.zeros(many, np.int64), []
        at, stack = 0, [(self.root, False)]
        while stack:
            k, done = stack.pop()
            a, b = self.children[k]
            if done:
                last[k] = at
            elif a < 0:
                first[k], at = at, at + len(self.members[k])
                last[k] = at
                order.append(self.members[k])
            else:
                first[k] = at
                stack += [(k, True), (b, False), (a, False)]
        order = np.concatenate(order)
        left, right = np.array(self.children).T
        total = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(points[order], axis=0)])
        sums = total[last] - total[first]
        centre = sums / (last - first)[:, None]
        radius = np.zeros(many)
        inside = self.points[order]
        for k in range(many):  # a child comes before its parent
            a, b = left[k], right[k]
            if a < 0:
                radius[k] = np.sqrt(((inside[first[k] : last[k]] - centre[k]) ** 2).sum(1).max())
            else:
                radius[k] = max(radius[c] + np.sqrt(((centre[c] - centre[k]) ** 2).sum()) for c in (a, b))
        return Balls(order, first, last, left, right, centre, radius, sums)


FIELDS = {"order": "<i4", "first": "<i4", "last": "<i4", "left": "<i4", "right": "<i4", "centre": "<f8", "radius": "<f8", "sums": "<i8"}
TREES = "rows array<{}>, points binary, many array<int>, " + ", ".join(f"{f} binary" for f in FIELDS)


class Trees:
    """The trees of all parts of a block, their nodes in one list."""

    def __init__(self, points: np.ndarray, parts: int, **stored):
        self.points = points.reshape(len(points), parts, -1)
        self.parts = parts
        if stored:
            self.__dict__ |= stored
            return
        found = [Builder(self.points[:, p]).balls(self.points[:, p]) for p in range(parts)]
        self.many = [len(f.first) for f in found]
        low = np.cumsum(self.many) - self.many
        shifted = {"left": low, "right": low, "order": None}
        for name in FIELDS:
            own = [getattr(f, name) for f in found]
            if shifted.get(name) is not None:
                own = [np.where(x < 0, -1, x + k) for x, k in zip(own, low.tolist(), strict=True)]
            setattr(self, name, np.concatenate(own))

    def owned(self, books: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The nearest entry of every point, and per part and entry the number of points and their sums.

        A ball takes over the entries its parent could not rule out, and rules out those that are farther than another
        from each of its points. A ball left with one entry is owned as a whole: its cached sums count, its points are
        not looked at. In leaves, points are compared with the entries left; ties go to the lower index.
        """
        size = len(self.points)
        entries = books.shape[1]
        table = books.astype(np.float64)
        gap = np.sqrt(((table[:, :, None] - table[:, None]) ** 2).sum(3))
        rounding = 1e-14 * max(float(np.abs(self.points).max(initial=0)), float(np.abs(table).max(initial=0))) ** 2
        code = np.zeros((self.parts, size), np.int64)
        count = np.zeros((self.parts, entries), np.int64)
        sums = np.zeros(books.shape, np.int64)
        part_of = np.repeat(np.arange(self.parts), self.many)
        ball = np.cumsum(self.many) - 1  # a root is the last of its part
        open_to = np.ones((self.parts, entries), bool)
        while len(ball):
            part = part_of[ball]
            away = ((self.centre[ball][:, None] - table[part]) ** 2).sum(2)
            away[~open_to] = np.inf
            best = away.argmin(1)
            least = away[np.arange(len(ball)), best]
            slack = SLACK * 2 * self.radius[ball][:, None] * gap[part, best] + 1e-9 * (least[:, None] + 1) + rounding
            beyond = away - least[:, None] > slack
            open_to = open_to & ~beyond
            whole = open_to.sum(1) == 1
            won, entry = ball[whole], open_to[whole].argmax(1)
            np.add.at(count, (part[whole], entry), self.last[won] - self.first[won])
            np.add.at(sums, (part[whole], entry), self.sums[won])
            which, at = ranges(self.first[won], self.last[won])
            code[part[whole][which], self.order[part[whole][which] * size + at]] = entry[which]
            end = ~whole & (self.left[ball] < 0)
            self.compare(books, ball[end], part[end], open_to[end], code, count, sums)
            on = ~whole & ~end
            ball, open_to = np.concatenate([self.left[ball[on]], self.right[ball[on]]]), np.concatenate([open_to[on]] * 2)
        return code.T, count, sums

    def compare(self, books, ball, part, open_to, code, count, sums) -> None:
        """Points of leaves against the entries their leaf has left."""
        size = len(self.points)
        which, at = ranges(self.first[ball], self.last[ball])
        for low in range(0, len(which), POINTS):
            leaf = which[low : low + POINTS]
            own = part[leaf]
            index = self.order[own * size + at[low : low + POINTS]]
            point, entry = np.nonzero(open_to[leaf])
            x = self.points[index, own]
            away = ((x[point] - books[own[point], entry]) ** 2).sum(1)
            starts = np.flatnonzero(np.append(True, point[1:] != point[:-1]))
            least = np.minimum.reduceat(away, starts)
            hit = np.flatnonzero(away == least[point])
            first = hit[np.append(True, point[hit][1:] != point[hit][:-1])]  # the lowest of equal entries
            code[own, index] = entry[first]
            np.add.at(count, (own, entry[first]), 1)
            np.add.at(sums, (own, entry[first]), x)


def ranges(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The range each place of several ranges belongs to, and the places."""
    sizes = (last - first).astype(np.int64)
    which = np.repeat(np.arange(len(sizes)), sizes)
    return which, np.arange(len(which)) + np.repeat(first - (np.cumsum(sizes) - sizes), sizes)


# --- jobs ------------------------------------------------------------------------------------
def built(parts: int):
    """Trees of blocks of vectors."""

    def run(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, BLOCK):
                own = batch.slice(low, BLOCK)
                points = np.stack([np.asarray(v, np.int64) for v in own.column(1).to_pylist()])
                trees = Trees(points, parts)
                stored = [getattr(trees, f).astype(kind).tobytes() for f, kind in FIELDS.items()]
                rows = pa.ListArray.from_arrays(pa.array([0, own.num_rows], pa.int32()), own.column(0))
                yield pa.RecordBatch.from_arrays(
                    [rows, pa.array([points.astype("<i8").tobytes()]), pa.array([trees.many], pa.list_(pa.int32())), *[pa.array([x]) for x in stored]],
                    ["rows", "points", "many", *FIELDS],
                )

    return run


def held(batch: pa.RecordBatch, width: int, parts: int):
    """The trees of each block of a batch."""
    for k in range(batch.num_rows):
        own = {name: batch.column(name)[k] for name in batch.schema.names}
        points = np.frombuffer(own["points"].as_py(), "<i8").reshape(-1, width)
        stored = {f: np.frombuffer(own[f].as_py(), kind).astype("i8" if kind == "<i4" else kind[1:]) for f, kind in FIELDS.items()}
        for f in ("centre", "sums"):
            stored[f] = stored[f].reshape(-1, width // parts)
        yield k, Trees(points, parts, many=own["many"].as_py(), **stored)


def refined(books, width: int):
    """(part, entry, n, sums) of each batch of blocks."""

    def run(batches):
        now = books.value
        parts, entries = now.shape[:2]
        for batch in batches:
            count, sums = np.zeros((parts, entries), np.int64), np.zeros(now.shape, np.int64)
            for _, trees in held(batch, width, parts):
                _, n, s = trees.owned(now)
                count += n
                sums += s
            part, entry = np.nonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(count[part, entry]), pa.array(list(sums[part, entry]), pa.list_(pa.int64()))],
                ["part", "entry", "n", "sums"],
            )

    return run


def assigned(books, width: int):
    """(row, codes, error) of all vectors."""

    def run(batches):
        now = books.value
        parts = len(now)
        for batch in batches:
            for k, trees in held(batch, width, parts):
                rows = batch.column("rows").slice(k, 1).flatten()
                code, _, _ = trees.owned(now)
                error = ((trees.points - now[np.arange(parts), code]) ** 2).sum((1, 2))
                yield pa.RecordBatch.from_arrays(
                    [rows, pa.array(list(code.astype(np.int32)), pa.list_(pa.int32())), pa.array(error)], ["row", "codes", "error"]
                )

    return run


def whole_numbers(vector: Column) -> Column:
    """floor(256 * x) of every component."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("bigint"))


def compress(
    vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", carry: list[str] | None = None,
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> tuple[DataFrame, np.ndarray]:
    """(row, codes, error) of every vector, and the codebooks as (part, entry, component).

    Vectors that are NULL or hold NULLs, NaN or infinities are left out. Codebooks start from the ``entries`` smallest
    ids (fewer vectors give fewer entries; equal ids in the order of their components, NULL ids last); a round moves
    each entry to the floor of the mean of the parts nearest to it. Repeated rows count as often as they are there.
    Vectors of another length than the first one, and components so large that squares leave 64 bits (a million and
    more), have NULL codes and error and take no part; so has every vector if ``parts`` does not divide the length. No
    vectors give no rows and empty codebooks.

    Trees are built in blocks within tasks and written once; each round reads them with the codebooks, whose size is
    fixed by the parameters, and sums counts and sums per task before they are shuffled.
    """
    carry, spark = carry or vectors.columns, vectors.sparkSession
    given = F.col(f"`{vector_col}`")
    finite = given.isNotNull() & ~F.exists(given, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    own = vectors.where(finite).select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), whole_numbers(given).alias("v"), F.col(f"`{id_col}`").alias("id")
    )
    sized = own.where((F.size("v") > 0) & (F.size("v") % parts == 0))
    start = sized.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()  # a codebook
    width = len(start[0].v) if start else 0
    largest = isqrt((1 << 62) // max(1, width)) // 2
    fits = (F.size("v") == width) & (F.size("v") > 0) & ~F.exists("v", lambda x: (x > largest) | (x < -largest))
    left_out = own.where(~fits).select("row", F.lit(None).cast("array<int>").alias("codes"), F.lit(None).cast("bigint").alias("error"))
    if not start:
        return left_out, np.zeros((parts, 0, 0), np.int64)
    start = sized.where(fits).orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    if not start:
        return left_out, np.zeros((parts, 0, width // parts), np.int64)
    books = np.array([r.v for r in start], np.int64).reshape(len(start), parts, -1).transpose(1, 0, 2)
    kind = own.schema["row"].dataType.simpleString()
    trees = settled(own.where(fits).select("row", "v").mapInArrow(built(parts), TREES.format(kind)), "metric-trees")
    context = spark.sparkContext
    for _ in range(rounds):
        moved = trees.drop("rows").mapInArrow(refined(context.broadcast(books), width), "part int, entry int, n bigint, sums array<bigint>")
        each = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width // parts)]
        books = books.copy()
        for r in moved.groupBy("part", "entry").agg(F.sum("n").alias("n"), *each).collect():  # one row per entry
            books[r.part, r.entry] = [int(r[f"s{i}"]) // r.n for i in range(width // parts)]
    schema = T.StructType([own.schema["row"], *T.StructType.fromDDL("codes array<int>, error bigint").fields])
    found = trees.select("rows", "points", "many", *FIELDS).mapInArrow(assigned(context.broadcast(books), width), schema)
    return found.unionByName(left_out), books


# the same in SQL: parts and entries as rows, nearest entries by windows
def _sql() -> str:
    away = "list_sum(list_transform(range(1, len(p.v) + 1), lambda i: (p.v[i] - b.v[i]) * (p.v[i] - b.v[i])))"

    def nearest(k: int) -> str:
        return (
            f"SELECT n, part, v, (arg_min(entry, away * {ENTRIES} + entry))::INTEGER AS entry, min(away) AS away FROM "
            f"(SELECT p.n, p.part, p.v, b.entry, {away} AS away FROM p JOIN b{k} b USING (part)) GROUP BY n, part, v"
        )

    steps = []
    for k in range(ROUNDS):
        steps.append(
            f"""a{k} AS ({nearest(k)}),
  m{k} AS (SELECT part, entry, i, sum(v[i])::BIGINT AS s, count(*) AS c FROM a{k}, range(1, 1025) t(i) WHERE i <= len(v) GROUP BY ALL),
  f{k} AS (SELECT part, entry, list((s - ((s % c) + c) % c) // c ORDER BY i) AS v FROM m{k} GROUP BY ALL),
  b{k + 1} AS (SELECT part, entry, coalesce(f{k}.v, b{k}.v) AS v FROM b{k} LEFT JOIN f{k} USING (part, entry))"""
        )
    rounds = ", ".join(steps)
    return f"""WITH e AS (SELECT row_number() OVER (ORDER BY vec_id) AS n, vec_id, label,
      list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS w FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  p AS (SELECT n, part::INTEGER AS part, w[part * len(w) // {PARTS} + 1 : (part + 1) * len(w) // {PARTS}] AS v
    FROM e, range({PARTS}) t(part)),
  b0 AS (SELECT part, (n - 1)::INTEGER AS entry, v FROM p WHERE n <= {ENTRIES}),
  {rounds},
  z AS ({nearest(ROUNDS)}),
  c AS (SELECT n, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(away)::BIGINT AS error FROM z GROUP BY n),
  h AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{ROUNDS})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM c JOIN e USING (n), h"""


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components of the codebooks as text, by part, entry and place."""
    return sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


@query("op12_vector_code_compression", _sql())
def op12(spark, folder):
    found, books = compress(read(spark, folder, "embeddings"), carry=["vec_id", "label"])
    digits = F.transform("codes", lambda x: F.lower(F.lpad(F.hex(x), 2, "0")))
    rows = found.select("row.*", F.when(F.col("codes").isNotNull(), F.array_join(digits, "")).alias("code"), "error")
    rows = settled(rows, "codes")
    sums = rows.groupBy("label").agg(F.sum("error").alias("label_error"))
    return attach(rows, sums, ["label"]).select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))

"""N-gram Jaccard join by a token-group matrix: exact links between sets of word shingles."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import drop, intermediates, roll, store


def words_of(text: str | None) -> list[bytes]:
    """Runs of anything but the six ASCII spaces, A-Z lowered. Bytes know no other spaces or capitals."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


class _Hashes(dict):
    """Word hashes, kept for words of up to 24 bytes while there are fewer than 500,000."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 24 and len(self) < 500_000:
            self[word] = value
        return value


_HASHES = _Hashes()


def shingles(words: list[bytes], n: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of word n-grams; fewer words are one shingle, none none."""
    if not words:
        return np.zeros(0, np.uint64)
    ids = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    if len(ids) < n:
        return roll(np.append(ids, np.uint64(len(ids))), len(ids) + 1)
    return np.unique(roll(ids, n))


def shingle_set(text: str | None, n: int = 5) -> np.ndarray:
    return shingles(words_of(text), n)


def least_overlap(n: int, percent: int) -> int:
    """Fewest common elements of a set of n with any set at this similarity."""
    return -(-n * percent // 100)


def jaccard_components(
    spark: SparkSession,
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    n: int = 5,
    percent: int = 75,
    chunk: int = 128,
    share: float = 0.34,
    rounds: int = 3,
) -> DataFrame:
    """Per document: key, n_shingles, component_id (smallest key reachable by links, itself included).

    1. Texts with the same word sequence become one class.
    2. A class with more than n - ceil(0.75 n) shingles of its own, held by no other class, links with nothing. They
       are counted among the shingles of a fixed `share` of the hash range first, then, for the classes that are
       left, among all. What remains has its shingles ordered by the exact number of classes that hold them. Two sets
       that link share one of each other's first n - ceil(0.75 n) + 1 shingles (the prefix); own ones come first and join nothing.
    3. In the posting list of a prefix shingle one class is the hub, one with little of its own; each class of another
       component is compared with that of its hubs that shares most of its prefix, which joins copies by stars, not by
       pairs. This is done `rounds` times with other hubs; lists that lie in one component are done.
    4. Classes that a star has joined form groups of at most `chunk` (more are split by hash). A class of another
       component that shares enough prefix shingles with a group is counted against the group's matrix of shingles
       and members, which gives its overlap with each of them. All components that a link joins are found.

    Classes meet under the first 64 of their 128 bits; two texts that agree there and link with each other alone are lost.

    Null and empty texts have no shingles and are alone. Null keys give rows of their own with a null
    component and link nothing. Repeated keys are rows of their own. Empty tables give no rows; extra
    columns are ignored. Texts of any length are read whole.
    """

    with intermediates(spark, "jaccard") as run:
        return run.lasting(_components_of(spark, docs, key, text, n, percent, chunk, share, rounds), "jac-result")


def _components_of(
    spark: SparkSession, docs: DataFrame, key: str, text: str, n: int, percent: int, chunk: int, share: float, rounds: int
) -> DataFrame:
    given = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
    # Ranges of hashes: a fixed number for each part of the input, so that the size of one does not grow with it.
    ranges = max(256, 4 * given.rdd.getNumPartitions())
    measured = store(spark, given.mapInArrow(_measure(n, int(share * 2**64), ranges), f"{MEASURED}, {PACKED}"), "jac-rows")
    rows = store(spark, measured.where("part IS NULL").select("k", "digest", "n"), "jac-documents")
    classes = measured.where("digest IS NOT NULL AND k IS NOT NULL").groupBy("digest")
    folded = [*[F.first(x).alias(x) for x in ("d", "n", "sampled")], F.sum("met").alias("near")]
    classes = classes.agg(F.min("k").alias("c"), *folded).join(_met(measured), "d", "left")
    own = F.col("sampled") - F.col("near") - F.coalesce("met", F.lit(0))
    most = F.col("n") - F.ceil(F.col("n") * percent / 100)
    classes = store(spark, classes.select("digest", "c", "d", "n", (own <= most).alias("open")), "jac-classes")
    drop(measured)
    known = _candidates(spark, _sets(spark, given, classes.where("open"), n), ranges, percent)
    posts = _prefixes(spark, known, percent)
    linked = spark.createDataFrame([], "a long, b long")
    comps = None
    for turn in range(rounds):
        posts = _unsettled(spark, posts, comps)
        found = _verify(spark, known, _stars(posts, turn, percent), percent)
        linked = linked.unionByName(found)
        comps = components(spark, linked)
    posts = _unsettled(spark, posts, comps)
    grouped = store(spark, _groups(posts, linked, chunk), "jac-groups")
    more = _cross(spark, known, posts, grouped, percent)
    drop(posts, known)
    final = components(spark, linked.unionByName(more)).select(F.col("v").alias("c"), F.col("comp"))
    by_class = classes.join(final, "c", "left").select("digest", F.coalesce("comp", "c").alias("comp"))
    # Stored, so that Spark knows its size; rows of a class that holds a third of them are split by Spark.
    by_class = store(spark, by_class, "jac-by-class")
    return rows.join(by_class, "digest", "left").select(
        F.col("k").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("k").isNotNull(), F.coalesce("comp", "k")).alias("component_id")
    )


MEASURED = "k long, digest binary, n long, sampled long, met long, d long"
PACKED = "part int, hashes binary, owners binary"


def _columns(schema: str, **given: pa.Array) -> pa.RecordBatch:
    """A batch with the given columns, the others null."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    size = len(next(iter(given.values())))
    named = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([given.get(c, pa.nulls(size, kinds[k])) for c, k in named], [c for c, _ in named])


def _measure(n: int, bound: int, ranges: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One pass over the texts: a row per document, and the shingles under the bound by ranges, with the class's short digest."""
    schema = f"{MEASURED}, {PACKED}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, sizes, shorts, sampled, posted = [], [], [], [], {}
            keys = batch["k"].to_pylist()
            for i, (k, t) in enumerate(zip(keys, batch["t"].to_pylist())):
                words = words_of(t)
                own = shingles(words, n)
                digest = xxhash.xxh3_128_digest(b" ".join(words)) if words else None
                heads = own[: np.searchsorted(own, np.uint64(bound))]
                digests.append(digest)
                sizes.append(len(own))
                sampled.append(len(heads))
                shorts.append(int.from_bytes(digest[:8], "little", signed=True) if digest else None)
                if digest and k is not None and shorts[-1] not in posted:
                    posted[shorts[-1]] = i, heads
            met, packed = pack(list(posted), [heads for _, heads in posted.values()], bound, ranges)
            near = np.zeros(len(keys), np.int64)
            near[[i for i, _ in posted.values()]] = met
            ints = {x: pa.array(v, pa.int64()) for x, v in (("k", keys), ("n", sizes), ("sampled", sampled), ("met", near), ("d", shorts))}
            yield _columns(schema, digest=pa.array(digests, pa.binary()), **ints)
            if packed:
                yield _columns(schema, **packed)

    return run


def pack(owners: list[int], sets: list[np.ndarray], bound: int, ranges: int) -> tuple[np.ndarray, dict[str, pa.Array]]:
    """How many shingles of each set another one here holds as well; the shingles in ranges, 32 bits of each and its owner.

    Of a shingle with several owners here, which are counted, one entry goes on, with owner 0. Shingles that agree
    in these bits count as one: a class may seem to share more than it does, never less.
    """
    met = np.zeros(len(owners), np.int64)
    if not sum(map(len, sets)):
        return met, {}
    flat = np.concatenate(sets)
    place = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(flat)
    flat, place = flat[order], place[order]
    new = np.append(True, flat[1:] != flat[:-1])
    alone = new & np.append(new[1:], True)
    met += np.bincount(place[~alone], minlength=len(met))
    kept = np.array(owners, np.int64)[place]
    kept[~alone] = 0
    flat, kept = flat[new], kept[new]
    width = np.uint64(bound // ranges + 1)
    part = (flat // width).astype(np.int32)
    low = ((flat - part.astype(np.uint64) * width) >> np.uint64(max(0, int(width).bit_length() - 32))).astype(np.uint32)
    starts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    ends = np.append(starts[1:], len(part)).tolist()
    cut = list(zip(starts.tolist(), ends))
    return met, {
        "part": pa.array(part[starts]),
        "hashes": pa.array([low[a:b].tobytes() for a, b in cut], pa.binary()),
        "owners": pa.array([kept[a:b].tobytes() for a, b in cut], pa.binary()),
    }


def _met(packed: DataFrame) -> DataFrame:
    """d, met: how many of its shingles in the ranges a class shares with classes of other batches."""

    def shared(table: pa.Table) -> pa.Table:
        hashes = np.concatenate([np.frombuffer(x, np.uint32) for x in table["hashes"].to_pylist()])
        owners = np.concatenate([np.frombuffer(x, np.int64) for x in table["owners"].to_pylist()])
        order = np.lexsort((owners, hashes))
        hashes, owners = hashes[order], owners[order]
        first = np.append(True, hashes[1:] != hashes[:-1])
        new = first | np.append(True, owners[1:] != owners[:-1])  # copies in several batches count once
        hashes, owners, first = hashes[new], owners[new], first[new]
        several = ~(first & np.append(first[1:], True)) & (owners != 0)
        found, times = np.unique(owners[several], return_counts=True)
        return pa.table({"d": pa.array(found, pa.int64()), "met": pa.array(times.astype(np.int64))})

    entries = packed.where("part IS NOT NULL").select("part", "hashes", "owners")
    return entries.groupBy("part").applyInArrow(shared, "d long, met long").groupBy("d").agg(F.sum("met").alias("met"))


def _candidates(spark: SparkSession, sets: DataFrame, ranges: int, percent: int) -> DataFrame:
    """c, d, n, s: the sets of which other sets hold enough. Takes the place of `sets`."""
    schema = f"d long, met long, {PACKED}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = dict(zip(batch["d"].to_pylist(), batch["s"]))
            met, packed = pack(list(own), [s.values.to_numpy().view(np.uint64) for s in own.values()], 2**64, ranges)
            yield _columns(schema, d=pa.array(list(own), pa.int64()), met=pa.array(met))
            if packed:
                yield _columns(schema, **packed)

    packed = store(spark, sets.select("d", "s").mapInArrow(run, schema), "jac-packed")
    met = packed.where("part IS NULL").select("d", "met").unionByName(_met(packed)).groupBy("d").agg(F.sum("met").alias("met"))
    # Stored, so that Spark knows their size when it chooses the join.
    met = store(spark, met, "jac-met")
    drop(packed)
    near = sets.join(met, "d").where(F.col("met") * 100 >= F.col("n") * percent)
    # A key may have two spellings of one text.
    known = store(spark, near.select("c", "d", "n", "s").dropDuplicates(["c", "d"]), "jac-known")
    drop(sets, met)
    return known


def _prefixes(spark: SparkSession, known: DataFrame, percent: int) -> DataFrame:
    """token, c, n, m: the shingles of each class's prefix that another class holds as well; m of its n are held so."""
    once = known.select(F.explode("s").alias("token"), "d")
    held = once.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    # Stored, so that Spark splits a list that many classes hold before they are sorted by class.
    counted = store(spark, once.join(held, "token"), "jac-counted")
    by_class = counted.join(known.select("c", "d", "n"), "d")
    # A window's rows are shingles of one text. Those of one class stand before these.
    text = Window.partitionBy("c", "d")
    placed = by_class.select(
        "token", "c", "n", F.row_number().over(text.orderBy("df", "token")).alias("place"), F.count(F.lit(1)).over(text).alias("m")
    )
    inside = F.col("place") <= F.col("m") - F.ceil(F.col("n") * percent / 100) + 1
    posts = store(spark, placed.where(inside).select("token", "c", "n", "m"), "jac-posts")
    drop(counted)
    return posts


def _unsettled(spark: SparkSession, posts: DataFrame, comps: DataFrame | None) -> DataFrame:
    """token, c, n, m, comp: the lists whose classes are not all in one component. Takes the place of `posts`."""
    if comps is None:
        tagged = posts.select("token", "c", "n", "m", F.col("c").alias("comp"))
    else:
        tagged = posts.select("token", "c", "n", "m").join(comps.select(F.col("v").alias("c"), "comp"), "c", "left")
        tagged = tagged.withColumn("comp", F.coalesce("comp", "c"))
    mixed = tagged.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("token")
    left = store(spark, tagged.join(mixed, "token", "left_semi"), "jac-lists")
    drop(posts)
    return left


def _stars(posts: DataFrame, turn: int, percent: int) -> DataFrame:
    """a, b: each class with the best hub of another component in its lists. What stars leave out is found between components."""
    # Hubs have little of their own, and so most links in a family of near copies; later ones are drawn from more classes.
    centre = F.floor((F.col("n") - F.col("m")) * (20 if turn == 0 else 12) / F.col("n"))
    first = F.min(F.struct(centre.alias("own"), F.xxhash64("c", F.lit(turn)).alias("h"), "c", "n", "m", "comp"))
    hubs = posts.groupBy("token").agg(first.alias("hub"))
    hubs = hubs.select("token", F.col("hub.c").alias("hub"), *[F.col(f"hub.{x}").alias(f"hub_{x}") for x in ("n", "m", "comp")])
    met = posts.join(hubs, "token").where("comp <> hub_comp")
    met = met.where(F.expr(f"least(n, hub_n) * 100L >= greatest(n, hub_n) * {percent}L"))
    # What both have in common is at most what either shares with any class.
    met = met.where(F.expr(f"least(m, hub_m) * {100 + percent}L >= (n + hub_n) * {percent}L"))
    stars = met.groupBy("hub", "c", "n", "hub_n").agg(F.count(F.lit(1)).alias("common"))
    stars = stars.where(F.col("common") >= _shared_least(F.col("n"), F.col("hub_n"), percent))
    best = stars.groupBy(F.col("c").alias("b")).agg(F.max(F.struct("common", "hub")).alias("best"))
    return best.select(F.col("best.hub").alias("a"), "b")


def _shared_least(x: Column, y: Column, percent: int) -> Column:
    """Fewest common prefix shingles that sets of sizes x and y need to link.

    Up to the end of the prefix that ends first, all common shingles are in both prefixes; after it that
    set has ceil(percent x) - 1 left, and a link needs percent / (100 + percent) of x + y in common.
    """
    need = F.ceil((x + y) * percent / (100 + percent) - 1e-9)
    return need - F.ceil(F.greatest(x, y) * percent / 100) + 1


def _sets(spark: SparkSession, given: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """c, d, n, s: the shingles of each wanted class. A repeated key may have several texts, so they are told apart by digest."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, shorts, found = [], [], []
            for k, t, digest, d in zip(*(batch[x].to_pylist() for x in ("k", "t", "digest", "d"))):
                words = words_of(t)
                if words and xxhash.xxh3_128_digest(b" ".join(words)) == digest:
                    kept.append(k)
                    shorts.append(d)
                    found.append(shingles(words, n).view(np.int64))
            lengths = np.cumsum([0] + [len(s) for s in found])
            flat = np.concatenate(found) if found else np.zeros(0, np.int64)
            ints = [pa.array(x, pa.int64()) for x in (kept, shorts, np.diff(lengths))]
            lists = pa.ListArray.from_arrays(pa.array(lengths.astype(np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*ints, lists], ["c", "d", "n", "s"])

    # Written first, so that Spark knows their size when it chooses the join.
    asked = store(spark, wanted.select(F.col("c").alias("k"), "digest", "d"), "jac-wanted")
    # Of a row that is repeated as a whole one text is read; grouped by key and digest, as texts are long.
    texts = given.join(asked, "k").groupBy("k", "digest", "d", F.xxhash64("t").alias("same")).agg(F.first("t").alias("t"))
    known = store(spark, texts.select("k", "digest", "d", "t").mapInArrow(sets, "c long, d long, n long, s array<long>"), "jac-sets")
    drop(asked)
    return known


def _verify(spark: SparkSession, known: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets link. Pairs are written first, so that Spark knows their number when it chooses the joins."""
    pairs = store(spark, pairs, "jac-pairs")
    both = pairs.join(known.select(F.col("c").alias("b"), F.col("s").alias("sb")), "b").join(
        known.select(F.col("c").alias("a"), F.col("s").alias("sa")), "a"
    )
    common = F.size(F.array_intersect("sa", "sb")).cast("long")
    size = (F.size("sa") + F.size("sb")).cast("long")
    links = both.where(common * 100 >= (size - common) * percent).select("a", "b")
    links = store(spark, links, "jac-links")
    drop(pairs)
    return links


def _groups(posts: DataFrame, linked: DataFrame, chunk: int) -> DataFrame:
    """c, comp, grp: members of a star share a group, split by hash when there are more than `chunk`."""
    star = linked.groupBy(F.col("b").alias("c")).agg(F.min("a").alias("hub"))
    every = posts.select("c", "comp").distinct().join(star, "c", "left").withColumn("hub", F.coalesce("hub", "c"))
    # A class that is a hub for others may have one of its own in another round; either group is of its component.
    parts = every.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / chunk).alias("parts"))
    return every.join(parts, "hub").select("c", "comp", F.xxhash64("hub", F.pmod(F.xxhash64("c"), F.col("parts"))).alias("grp"))


def _cross(spark: SparkSession, known: DataFrame, posts: DataFrame, grouped: DataFrame, percent: int) -> DataFrame:
    """Links between components: query classes against group unions, then members of opened groups."""
    tagged = store(spark, posts.join(grouped.select("c", "grp"), "c"), "jac-mixed")
    # What two have in common is at most what either shares with any class, its m. `reach` is what that leaves for the other's size.
    spare = F.col("m") * (100 + percent) - F.col("n") * percent
    by_group = tagged.groupBy("token", "grp", "comp").agg(F.min("n").alias("n_lo"), F.max("n").alias("n_hi"), F.max(spare).alias("reach"))
    # The larger component queries the smaller; either side of a link is enough.
    asks = (
        tagged.alias("q")
        .join(by_group.alias("g"), F.expr("q.token = g.token AND q.comp > g.comp"))
        .where(F.expr(f"q.n * 100L >= g.n_lo * {percent}L AND g.n_hi * 100L >= q.n * {percent}L"))
        .where(F.expr(f"g.reach >= q.n * {percent}L AND q.m * {100 + percent}L >= (q.n + g.n_lo) * {percent}L"))
        .groupBy("q.c", "q.n", "g.grp")
        .agg(F.count(F.lit(1)).alias("common"), F.min("g.n_lo").alias("n_lo"), F.max("g.n_hi").alias("n_hi"))
    )
    # Among the sizes of a group, the least is needed at one of the ends that can link at all; rounding adds 1 at most.
    low = F.greatest(F.col("n_lo"), F.ceil(F.col("n") * percent / 100))
    high = F.least(F.col("n_hi"), F.floor(F.col("n") * 100 / percent))
    least = F.least(_shared_least(F.col("n"), low, percent), _shared_least(F.col("n"), high, percent))
    asks = store(spark, asks.where(F.col("common") >= least - 1).select("c", "grp").distinct(), "jac-asks")
    # The classes that ask one group are cut into parts, so that a part's shingles have a bound.
    sized = asks.join(known.select("c", "n"), "c").groupBy("grp").agg(F.sum("n").alias("n"))
    parts = store(spark, sized.select("grp", F.ceil(F.col("n") / PART_SHINGLES).alias("parts")), "jac-parts")
    asking = asks.join(parts, "grp").withColumn("part", F.pmod(F.xxhash64("c"), F.col("parts"))).select("c", "grp", "part")
    members = grouped.join(parts, "grp").select("c", "grp", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    sets = known.select("c", "s")
    asking = asking.join(sets, "c").toDF("b", "grp", "part", "sb").groupBy("grp", "part")
    members = members.join(sets, "c").toDF("a", "of", "of_part", "sa").groupBy("of", "of_part")
    links = store(spark, asking.cogroup(members).applyInArrow(_match(percent), "a long, b long"), "jac-links")
    drop(tagged, asks, parts)
    return links


PART_SHINGLES = 1 << 20


def _match(percent: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """a, b: for each asking class b one member a of the group that it links with; the members are of one component."""

    def run(asking: pa.Table, members: pa.Table) -> pa.Table:
        names, sizes = members["a"].to_numpy(), [len(s) for s in members["sa"]]
        found: list[tuple[int, int]] = []
        if len(names):
            sets = members["sa"].combine_chunks().flatten().to_numpy()
            order = np.argsort(sets)
            sets, who, sizes = sets[order], np.repeat(np.arange(len(names)), sizes)[order], np.array(sizes)
            for c, s in zip(asking["b"].to_pylist(), asking["sb"]):
                own = s.values.to_numpy()
                first = np.searchsorted(sets, own)
                times = np.searchsorted(sets, own, "right") - first
                at = np.repeat(first - np.cumsum(times) + times, times) + np.arange(times.sum())
                common = np.bincount(who[at], minlength=len(names))
                linked = np.flatnonzero(common * 100 >= (len(own) + sizes - common) * percent)
                if len(linked):
                    found.append((int(names[linked[0]]), c))
        return pa.table({x: pa.array([row[i] for row in found], pa.int64()) for i, x in enumerate("ab")})

    return run


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """v, comp: smallest vertex reachable, by rounds of neighbour minimum and pointer jumping."""
    both = edges.select(F.col("a").alias("v"), F.col("b").alias("w")).union(edges.select(F.col("b"), F.col("a")))
    both = store(spark, both.distinct(), "cc-edges")
    state = kept = store(spark, both.groupBy("v").agg(F.least(F.min("w"), F.first("v")).alias("comp")), "cc-state")
    while True:
        near = both.join(state.select(F.col("v").alias("w"), F.col("comp").alias("near")), "w").groupBy("v").agg(F.min("near").alias("near"))
        step = state.join(near, "v").select("v", "comp", F.least("comp", "near").alias("next"))
        jump = step.select(F.col("v").alias("next"), F.col("next").alias("far"))
        new = step.join(jump, "next", "left").select("v", "comp", F.least("next", "far").alias("next"))
        new = store(spark, new, "cc-state")
        moved = new.where("comp <> next").limit(1).count()
        drop(kept)
        state, kept = new.select("v", F.col("next").alias("comp")), new
        if not moved:
            drop(both)
            return state

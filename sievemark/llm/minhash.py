"""Near-duplicate texts: MinHash signatures joined by Hamming distance.

A text's signature has ``slots`` places of 16 bits, the low bits of its minimal
shingle hashes; the distance of two signatures is the number of places in which
they differ. The signature is cut into chunks. Two signatures at a distance of at
most chunks * (errors + 1) - 1 agree in some chunk but for ``errors`` places (the
pigeonhole principle), so every chunk is indexed once for each choice of its
places that may be wrong, with those left out: one key each, and all pairs within
the radius share a key. ``scheme`` picks chunks so long that a pair of texts at the
similarity asked for shares no key with a probability below 2e-6.

So signatures at a distance of at most ``Scheme.radius`` always meet; those of a
distance between it and ``Scheme.prune`` are compared if they meet, which a pair of
texts at the threshold fails to with the probability named. Signature places are left
out rather than flipped: an error changes a place's 16 bits at random, and to flip
them one would need 65,535 keys where one key without the place serves.

Pairs that share a key, whose sets are of like size and whose signatures are near
are confirmed on the full shingle sets (64-bit hashes).
Texts with equal sets are one vertex. Each vertex is first held against the pivot
with which it shares most keys; only vertices of different components go on. Those
of keys that many share are compared in tiles of bounded size, which yield a
forest of links and no pairs; those of other keys as pairs. No pair between
different components is left unconfirmed.

Defined results: a text without words (null, empty, white space) has no shingles
and links with nothing; repeated rows are equal texts; if an id comes with
several texts it has the links of all of them; a null id stands for itself and
never represents others; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import give_back
from .components import connected_components
from .storage import Workspace, among
from .words import mix, shingle_sets

#: Vertices of a key compared by a join; those of larger keys are dealt into blocks
#: of this size, whose sets are compared some columns at a time.
SMALL, TILE, COLUMNS = 32, 512, 8_192
#: Texts in a slice of an Arrow batch.
ROWS = 256


@dataclass(frozen=True)
class Scheme:
    slots: int
    chunks: int
    errors: int
    prune: int  # a distance that no pair at the threshold exceeds (6 sigma)

    @property
    def width(self) -> int:
        return self.slots // self.chunks

    @property
    def radius(self) -> int:
        """Pairs of signatures at this distance are always found."""
        return self.chunks * (self.errors + 1) - 1

    def miss(self, similarity: float) -> float:
        """The probability that a pair of this similarity shares no key."""
        return _unlike(similarity, self.width, self.errors) ** self.chunks


def _unlike(s: float, width: int, errors: int) -> float:
    return 1 - sum(math.comb(width, k) * (1 - s) ** k * s ** (width - k) for k in range(errors + 1))


def scheme(similarity: float, chunks: int = 8, errors: int = 1, miss: float = 2e-6) -> Scheme:
    """The longest chunks that keep the miss probability at ``similarity``."""
    width = errors + 1
    while _unlike(similarity, width + 1, errors) ** chunks <= miss and width < 12:
        width += 1
    slots = width * chunks
    return Scheme(slots, chunks, errors, math.ceil(slots * (1 - similarity) + 6 * math.sqrt(slots * similarity * (1 - similarity))))


def signatures(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """Low 16 bits of the minimum of each of ``slots`` permutations; all sets non-empty."""
    flat = np.concatenate(sets)
    begins = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    seeds = mix(np.arange(1, 2 * slots + 1, dtype=np.uint64))
    out = np.empty((len(sets), slots), "<u2")
    for k in range(slots):
        turned = (flat ^ seeds[2 * k]) * (seeds[2 * k + 1] | np.uint64(1))
        turned ^= turned >> np.uint64(32)
        out[:, k] = (mix(np.minimum.reduceat(turned, begins)) & np.uint64(0xFFFF)).astype(np.uint16)
    return out


def sketch(df: DataFrame, key: str, text: str, words: int, slots: int) -> DataFrame:
    """(id, n_shingles, set_hash, sig) of each row; without shingles, null hash and signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                sets = shingle_sets(part.column(1).to_pylist(), words)
                full = [s for s in sets if len(s)]
                sigs = iter(signatures(full, slots) if full else ())
                hashes = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(hashes, pa.binary()), pa.array([next(sigs).tobytes() if len(s) else None for s in sets], pa.binary())],
                    names=["id", "n_shingles", "set_hash", "sig"],
                )
        give_back()

    return df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text")).mapInArrow(run, "id long, n_shingles long, set_hash binary, sig binary")


def _place(sig: Column, place: Column) -> Column:
    return F.substring(sig, 2 * place + 1, F.lit(2))


def _keys(sig: Column, s: Scheme) -> Column:
    """One hash for each chunk and each choice of its places left out. An array function over
    the choices, as code written out for each would be long to compile."""
    kept = [[chunk * s.width + p for p in range(s.width) if p not in left_out] for chunk in range(s.chunks) for left_out in combinations(range(s.width), s.errors)]
    choices = F.array(*(F.array(*map(F.lit, places)) for places in kept))
    return F.transform(choices, lambda places, i: F.xxhash64(i, F.transform(places, lambda p: _place(sig, p))))


def _distance(a: Column, b: Column, slots: int) -> Column:
    places = F.sequence(F.lit(0), F.lit(slots - 1))
    return F.size(F.filter(places, lambda k: _place(a, k) != _place(b, k)))


def _may_link(a: str, b: str, s: Scheme, percent: int) -> Column:
    """Whether two vertices can be similar enough by the sizes of their sets (exact:
    no intersection exceeds the smaller one) and by their signatures."""
    sizes = F.col(f"n_{a}"), F.col(f"n_{b}")
    return (100 * F.least(*sizes) >= percent * F.greatest(*sizes)) & (_distance(F.col(f"sig_{a}"), F.col(f"sig_{b}"), s.slots) <= s.prune)


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets are similar enough."""
    a = sets.select(F.col("id").alias("u"), F.col("shingles").alias("a"))
    b = sets.select(F.col("id").alias("v"), F.col("shingles").alias("b"))
    common = F.size(F.array_intersect("a", "b")).cast("long")
    near = 100 * F.col("common") >= percent * (F.size("a") + F.size("b") - F.col("common"))
    return pairs.select("u", "v").join(a, "u").join(b, "v").withColumn("common", common).where(near).select("u", "v")


def _common(first: list[np.ndarray], second: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, as products of incidence
    matrices over the shingles that occur on both sides, some columns at a time."""
    flat = [np.concatenate(x) for x in (first, second)]
    row = [np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (first, second)]
    both = np.intersect1d(*flat)
    out = np.zeros((len(first), len(second)), np.float64)
    at = [np.searchsorted(both, f) for f in flat]
    known = [(i < len(both)) & (both[np.minimum(i, len(both) - 1)] == f) if len(both) else np.zeros(len(f), bool) for i, f in zip(at, flat, strict=True)]
    for begin in range(0, len(both), COLUMNS):
        sides = []
        for side, x in enumerate((first, second)):
            here = known[side] & (at[side] >= begin) & (at[side] < begin + COLUMNS)
            m = np.zeros((len(x), min(COLUMNS, len(both) - begin)), np.float32)
            m[row[side][here], at[side][here] - begin] = 1
            sides.append(m)
        out += sides[0] @ sides[1].T
    return out


def _sides(key: tuple, rows: pa.Table) -> tuple[pa.Table, pa.Table]:
    return tuple(rows.filter(pc.equal(rows["mine"], k)) for k in key[1:])


def _asked(first: pa.Table, second: pa.Table, s: Scheme, percent: int) -> np.ndarray:
    """Which pairs of a tile lie in different components and may link."""
    a, b = (np.frombuffer(b"".join(x["sig"].to_pylist()), "<u2").reshape(len(x), s.slots) for x in (first, second))
    equal = np.zeros((len(a), len(b)), np.uint8)
    for k in range(s.slots):
        equal += a[:, k, None] == b[None, :, k]
    m, n = first["n"].to_numpy()[:, None], second["n"].to_numpy()[None, :]
    sizes = 100 * np.minimum(m, n) >= percent * np.maximum(m, n)
    return sizes & (s.slots - equal <= s.prune) & (first["comp"].to_numpy()[:, None] != second["comp"].to_numpy()[None, :])


def _ask_tile(key: tuple, rows: pa.Table, s: Scheme, percent: int) -> pa.Table:
    """The vertices of a tile whose sets are asked for."""
    first, second = _sides(key, rows)
    ask = _asked(first, second, s, percent)
    if key[1] == key[2]:  # the sides are the same
        return first.filter(pa.array(ask.any(1) | ask.any(0)))
    return pa.concat_tables([first.filter(pa.array(ask.any(1))), second.filter(pa.array(ask.any(0)))])


def _confirm_tile(key: tuple, rows: pa.Table, s: Scheme, percent: int) -> pa.Table:
    """The confirmed links of a tile between components, as a forest: (u, v) with v
    the smallest vertex that u reaches inside the tile."""
    left, right = _sides(key, rows)
    if not len(left) or not len(right):
        return pa.table({"u": pa.array([], pa.int64()), "v": pa.array([], pa.int64())})
    sizes = [pc.list_value_length(side["shingles"]).to_numpy() for side in (left, right)]
    sets = [np.split(pc.list_flatten(side["shingles"]).to_numpy(), np.cumsum(n)[:-1]) for side, n in zip((left, right), sizes, strict=True)]
    common = _common(*sets)
    near = _asked(left, right, s, percent) & (100 * common >= percent * (sizes[0][:, None] + sizes[1][None, :] - common))
    ids, place = np.unique(np.concatenate([left["id"].to_numpy(), right["id"].to_numpy()]), return_inverse=True)
    u, v = np.nonzero(near)
    u, v = place[u], place[len(left) + v]
    least = np.arange(len(ids))
    while True:
        new = least.copy()
        np.minimum.at(new, u, least[v])
        np.minimum.at(new, v, new[u])
        new = new[new]
        if (new == least).all():
            break
        least = new
    hang = np.flatnonzero(least != np.arange(len(ids)))
    return pa.table({"u": pa.array(ids[hang], pa.int64()), "v": pa.array(ids[least[hang]], pa.int64())})


def _hot_links(hot: DataFrame, sigs: DataFrame, sets_of, s: Scheme, percent: int, work: Workspace) -> DataFrame:
    """Links among the vertices of keys that very many vertices share.

    Vertices that such keys connect form a cluster; a cluster is dealt into blocks
    and each pair of blocks is a tile. Signatures alone move to the tiles first;
    the sets of the vertices that have a possible partner there follow and are
    compared at once. No list of pairs is ever written.
    """
    clusters = connected_components(hot.select(F.col("id").alias("u"), F.col("pivot").alias("v")), work).withColumnRenamed("component", "cluster")
    inside = hot.select("id", "comp").distinct().join(clusters, "id")
    blocks = inside.groupBy("cluster").agg(F.ceil(F.count("*") / TILE).cast("int").alias("blocks"))
    dealt = inside.join(blocks, "cluster").withColumn("mine", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt = dealt.join(among(sigs, inside.select("id")), "id").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("cluster", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "id", "comp", "n", "sig")

    def ask(key: tuple, rows: pa.Table) -> pa.Table:
        return _ask_tile(tuple(k.as_py() for k in key), rows, s, percent)

    def confirm(key: tuple, rows: pa.Table) -> pa.Table:
        return _confirm_tile(tuple(k.as_py() for k in key), rows, s, percent)

    asked = work.write(dealt.groupBy("cluster", "i", "j").applyInArrow(ask, dealt.schema), "asked")
    sets = sets_of(asked.select("id"))
    links = work.write(asked.join(sets, "id").groupBy("cluster", "i", "j").applyInArrow(confirm, "u long, v long"), "links")
    work.drop(asked, sets)
    return links


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """(id, n_shingles, component_id, kept) of each row of ``df``.

    Texts are linked if 100 * common >= ``percent`` * all of their distinct
    ``words``-word shingles; ``component_id`` is the smallest id reachable.
    """
    work = Workspace(df.sparkSession, "minhash")
    s = scheme(percent / 100)
    rows = work.write(sketch(df, key, text, words, s.slots), "sketch")
    classes = work.write(rows.where("n_shingles > 0 AND id IS NOT NULL").groupBy("set_hash").agg(F.min("id").alias("id"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig")), "classes", rows.count())
    found = _components(df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text")), rows, classes, s, words, percent, work)
    named = classes.select("set_hash", "id").join(found, "id", "left").select("set_hash", F.coalesce("component", "id").alias("component"))
    out = rows.select("id", "n_shingles", "set_hash").join(named, "set_hash", "left")
    component = F.coalesce("component", "id")
    return out.select("id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("id")).alias("kept"))


def _components(docs: DataFrame, rows: DataFrame, classes: DataFrame, s: Scheme, words: int, percent: int, work: Workspace) -> DataFrame:
    """(id, component) of the classes that have links."""
    keyed = classes.select("id", F.explode(_keys(F.col("sig"), s)).alias("key"))
    shared = keyed.groupBy("key").agg(F.min("id").alias("pivot"), F.max("id").alias("last")).where("pivot != last").select("key", "pivot")
    members = work.write(keyed.join(shared, "key"), "members")

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                sets = [x.view(np.int64) for x in shingle_sets(part.column(1).to_pylist(), words)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["id", "shingles"])
        give_back()

    repeated = rows.groupBy("id").count().where("count > 1").limit(1).count()

    def sets_of(ids: DataFrame) -> DataFrame:
        """The full sets of some vertices, read from their texts."""
        sets = among(docs, ids).mapInArrow(to_sets, "id long, shingles array<long>")
        return work.write(sets.distinct() if repeated else sets, "sets")

    def confirmed(pairs: DataFrame) -> DataFrame:
        sets = sets_of(pairs.select(F.explode(F.array("u", "v")).alias("id")))
        links = work.write(_confirm(pairs, sets, percent), "links")
        work.drop(sets)
        return links

    # Each vertex against the pivot with which it shares most keys.
    sigs = classes.select("id", "n", "sig")
    side = lambda c: sigs.select(F.col("id").alias(c), F.col("n").alias(f"n_{c}"), F.col("sig").alias(f"sig_{c}"))
    votes = members.where("id != pivot").groupBy("id", "pivot").count()
    best = votes.groupBy("id").agg(F.max_by("pivot", F.struct("count", -F.col("pivot"))).alias("v")).withColumnRenamed("id", "u")
    best = best.join(side("u"), "u").join(side("v"), "v")
    star = work.write(best.where(_may_link("u", "v", s, percent)).select("u", "v"), "star", classes.count())
    links = confirmed(star)
    found = connected_components(links, work)

    # What shares a key across components: hot keys in tiles, then the pairs of the others.
    n_members = members.count()

    def open_keys(found: DataFrame) -> DataFrame:
        labelled = members.select("key", "id", "pivot").join(found, "id", "left").select("key", "id", "pivot", F.coalesce("component", "id").alias("comp"))
        labelled = work.write(labelled, "labelled", n_members)
        still = labelled.groupBy("key").agg(F.min("comp").alias("least"), F.max("comp").alias("most"), F.count("*").alias("n")).where("least != most").select("key", "n")
        rows = work.write(labelled.join(still, "key"), "open", n_members)
        work.drop(labelled)
        return rows

    left = open_keys(found)
    hot = left.where(f"n > {SMALL}")
    if hot.limit(1).count():
        more = _hot_links(hot, sigs, sets_of, s, percent, work)
        work.drop(left)
        links = work.write(links.unionByName(more), "links", links.count() + more.count())
        found = connected_components(links, work)
        left = open_keys(found)
    few = left.where(f"n <= {SMALL}").select("key", "id", "comp").join(sigs, "id")
    a, b = (few.select("key", *(F.col(c).alias(f"{c}_{x}") for c in ("id", "comp", "n", "sig"))) for x in "ab")
    met = a.join(b, (a["key"] == b["key"]) & (F.col("id_a") < F.col("id_b")) & (F.col("comp_a") != F.col("comp_b")) & _may_link("a", "b", s, percent))
    pairs = work.write(met.select(F.col("id_a").alias("u"), F.col("id_b").alias("v")).distinct(), "pairs")
    more = confirmed(pairs)
    return connected_components(links.unionByName(more), work) if more.limit(1).count() else found

"""Near duplicates: SuperMinHash, banding, exact verification, union-find.

1. One scan gives each text its set size, a 128-bit digest of its shingle set and
   the hashes of its signature bands. Texts with equal sets form a class, and only
   classes go on.
2. A band bucket with two classes or more names candidates. Its leader is the
   class that shares most buckets with others, the hub of a group of copies;
   every member is compared with its leader on the full sets. That is one
   comparison for each member, however large the bucket. Union-find joins the links.
3. Two members of a bucket in different components may still be linked. They are
   found by their rarest shingles: in any order of all shingles, two sets that
   reach the threshold have their first common shingle within a short prefix of
   both. Shingles that occur in one component only come first, so texts that share
   a template but have words of their own have nothing in their prefix to meet by.
   Where prefixes meet, the positions bound the common shingles; pairs whose bound
   reaches the threshold are compared on the full sets.

Thus of the pairs that share a bucket each is linked, in one component, compared, or
proven apart. What is joined by a key that many rows share is joined by ``lookup`` or
in salted blocks, so no key, however frequent, is the work of one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import release, scratch, ship_package, written_tables
from ._common import TMP, bitmap_of, bitmap_size, lookup, resident, split_by_bitmap
from .byte_bpe import text_udf
from .components import components
from .superminhash import Shingler, band_hashes, super_min_hash

#: Bands, and signature slots in a band: a pair at 0.8 is missed once in 300,000
#: times, a pair at 0.85 once in 50 million times.
BANDS, ROWS = 24, 4

#: Pairs with one set, or rows with one shingle, that a task takes on at once.
BLOCK = 2_000


def _shingler(width: int) -> Shingler:
    return resident(("shingler", width), lambda: Shingler(width))


def _digest(elements: np.ndarray) -> tuple[int | None, int | None]:
    if not len(elements):
        return None, None
    d = xxhash.xxh3_128_intdigest(elements.tobytes())
    return int(np.int64(np.uint64(d >> 64).view(np.int64))), int(np.uint64(d & 0xFFFFFFFFFFFFFFFF).view(np.int64))


def _sketches(docs: DataFrame, id_col: str, text_col: str, width: int, bands: int, rows: int) -> DataFrame:
    """Rows ``id, n, d1, d2, bands``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = _shingler(width)
        for batch in batches:
            n, d1, d2, found = [], [], [], []
            for text in batch.column(1).to_pylist():
                elements = shingle(text)
                n.append(len(elements))
                a, b = _digest(elements)
                d1.append(a)
                d2.append(b)
                found.append(band_hashes(super_min_hash(elements, bands * rows), bands) if n[-1] else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(found, pa.list_(pa.int64()))],
                names=["id", "n", "d1", "d2", "bands"],
            )

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id long, n long, d1 long, d2 long, bands array<long>")


def _sets(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """Rows ``v, d, elements``: the full shingle set of each text; a null id as 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = _shingler(width)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for at in range(0, len(texts), 500):
                sets = [shingle(t) for t in texts[at : at + 500]]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, len(sets)), pa.array([_digest(s)[0] for s in sets], pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                    names=["v", "d", "elements"],
                )

    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "v long, d long, elements array<long>")


def _reaches(common: Column, n: Column, percent: int) -> Column:
    """Similarity of ``percent`` or more, in whole numbers: n is the sum of both set sizes."""
    return (100 + percent) * common >= percent * n


def _salted(pairs: DataFrame, sets: DataFrame, side: str) -> tuple[DataFrame, DataFrame]:
    """(``pairs`` with a column ``salt_`` + side, ``sets`` as ``v, d, salt, elements`` to join it with).

    A class in very many pairs, such as the leader of a large bucket, would draw all of
    them into one task. Its pairs are dealt over as many copies of its set as there are
    blocks of pairs; all other classes have the salt 0."""
    salt = "salt_" + side
    degree = pairs.groupBy(*[F.col(f"{side}.{c}").alias("hub_" + c) for c in "kvd"]).agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > BLOCK)
    many = scratch(degree.withColumn("blocks", F.ceil(F.col("m") / BLOCK).cast("int")), "hubs", settle=True)
    plain = F.lit(0).cast("long")
    if many.isEmpty():
        return pairs.withColumn(salt, plain), sets.select("v", "d", plain.alias("salt"), "elements")
    copies = many.select(F.col("hub_v").alias("v"), F.col("hub_d").alias("d"), F.sequence(plain, F.col("blocks").cast("long") - 1).alias("salts"))
    copied = sets.join(copies, ["v", "d"], "left").select("v", "d", F.explode(F.coalesce("salts", F.array(plain))).alias("salt"), "elements")
    dealt = lookup(pairs.withColumn("hub_k", F.col(f"{side}.k")), many.select("hub_k", "m", "blocks"), "hub_k", "m", pairs.count(), "left")
    dealt = dealt.withColumn(salt, F.pmod(F.xxhash64("x.k", "y.k"), F.coalesce("blocks", F.lit(1))))
    return dealt.drop("hub_k", "m", "blocks"), copied


def _linked(pairs: DataFrame, sets: DataFrame, percent: int, name: str) -> DataFrame:
    """``a, b`` (class numbers) of the ``pairs`` of classes (``x``, ``y``) that reach the
    threshold on the full sets. Pairs whose sizes rule it out are not compared."""
    n = F.col("x.n") + F.col("y.n")
    pairs = scratch(pairs.where(_reaches(F.least("x.n", "y.n"), n, percent)), name, settle=True)
    dealt, left = _salted(pairs, sets, "x")
    dealt, right = _salted(dealt, sets, "y")
    left, right = (df.select(*[F.col(c).alias(f"{side}_{c}") for c in df.columns]) for side, df in (("left", left), ("right", right)))

    def own(side: str, of: str) -> Column:
        return (F.col(f"{of}.v") == F.col(f"{side}_v")) & (F.col(f"{of}.d") == F.col(f"{side}_d")) & (F.col(f"salt_{of}") == F.col(f"{side}_salt"))

    both = dealt.join(left, own("left", "x")).join(right, own("right", "y"))
    common = F.size(F.array_intersect("left_elements", "right_elements")).cast("long")
    return scratch(both.where(_reaches(common, n, percent)).select(F.col("x.k").alias("a"), F.col("y.k").alias("b")), name + "-links", settle=True)


def _postings(classes: DataFrame) -> tuple[DataFrame, int]:
    """(``c, bucket, members`` of each class in a bucket with others, rows).

    Most buckets hold one class; a bit map of the others keeps theirs off the shuffle."""
    posted = classes.select(F.struct("k", "v", "d", "n").alias("c"), F.explode("bands").alias("bucket"))
    shared = scratch(posted.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1"), "buckets", settle=True)
    found, total = shared.agg(F.count(F.lit(1)), F.coalesce(F.sum("members"), F.lit(0))).first()
    bits = bitmap_size(found)
    maybe, _ = split_by_bitmap(posted, F.col("bucket"), bitmap_of(shared, F.col("bucket"), bits), bits)
    return scratch(lookup(maybe, shared, "bucket", "members", total, "inner"), "postings", settle=True), total


def _prefix_pairs(sets: DataFrame, open_classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (``x``, ``y``) of ``open_classes`` (``c, root``) with different roots whose
    prefixes meet and whose positions there leave the threshold within reach."""
    key = (F.col("v") == F.col("c.v")) & (F.col("d") == F.col("c.d"))
    held = scratch(sets.join(open_classes, key).select("c", "root", "elements"), "open-sets").select("c", "root", F.explode("elements").alias("e"))
    spread = held.groupBy("e").agg(F.count(F.lit(1)).alias("times"), F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("e", "times")
    spread = scratch(spread, "spread-shingles", settle=True)
    kinds, total = spread.agg(F.count(F.lit(1)), F.coalesce(F.sum("times"), F.lit(0))).first()
    bits = bitmap_size(kinds)
    maybe, _ = split_by_bitmap(held, F.col("e"), bitmap_of(spread, F.col("e"), bits), bits)
    met = lookup(maybe, spread, "e", "times", total, "inner")
    # Shingles of one component only come first in the order; they take places, but never meet.
    ordered = met.groupBy("c", "root").agg(F.sort_array(F.collect_list(F.struct("times", "e"))).alias("es"))
    alone = F.col("c.n") - F.size("es")
    prefix = F.col("c.n") - F.floor((F.col("c.n") * percent + 99) / 100) + 1
    ordered = ordered.withColumns({"alone": alone, "takes": (prefix - alone).cast("int")}).where("takes > 0")
    places = ordered.select("c", "root", "alone", F.posexplode(F.slice("es", F.lit(1), F.col("takes"))).alias("i", "s"))
    places = scratch(places.select("c", "root", F.col("s.e").alias("e"), (F.col("alone") + F.col("i")).alias("at")), "prefixes")
    lists = places.groupBy("e").agg(F.count(F.lit(1)).alias("m"), F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("e", "m")
    lists = scratch(lists, "prefix-lists", settle=True)
    rows = lists.agg(F.coalesce(F.sum("m"), F.lit(0))).first()[0]
    listed = scratch(lookup(places, lists, "e", "m", rows, "inner"), "listed", settle=True)
    # A long list is met block by block: each row once on the left, once for each block on the right.
    blocks = F.ceil(F.col("m") / BLOCK).cast("long")
    left = listed.select(F.col("c").alias("x"), F.col("root").alias("rx"), F.col("at").alias("ax"), "e", F.pmod(F.xxhash64("c.k"), blocks).alias("salt"))
    right = listed.select(F.col("c").alias("y"), F.col("root").alias("ry"), F.col("at").alias("ay"), "e", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("salt"))
    n = F.col("x.n") + F.col("y.n")
    bound = F.least(F.col("x.n") - F.col("ax"), F.col("y.n") - F.col("ay"))
    met = left.join(right, ["e", "salt"]).where((F.col("rx") != F.col("ry")) & (F.col("x.k") < F.col("y.k")) & _reaches(bound, n, percent))
    return met.select("x", "y").distinct()


def _links(docs: DataFrame, classes: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links (``a, b``) among ``classes`` (``k, v, d, n, bands``): those with leaders, and
    those found among the members of buckets that then still held two components."""
    before = written_tables(docs.sparkSession)
    postings, total = _postings(classes)
    # The leader of a bucket: the class with most neighbours over all its buckets.
    central = postings.groupBy(F.col("c.k").alias("k")).agg(F.sum(F.col("members") - 1).alias("neighbours"))
    ranked = postings.join(central, F.col("c.k") == F.col("k"))
    leaders = ranked.groupBy("bucket").agg(F.max(F.struct("neighbours", (-F.col("k")).alias("minus_k"), "c"))["c"].alias("leader"), F.count(F.lit(1)).alias("members"))
    leaders = scratch(leaders, "leaders", settle=True)
    led = scratch(lookup(postings.drop("members"), leaders, "bucket", "members", total, "inner").drop("members"), "led", settle=True)
    # Full sets of the candidates only; a bit map of fixed size picks them in the scan.
    wanted = scratch(postings.select(F.col("c.v").alias("v")).distinct(), "candidates", settle=True)
    bits = bitmap_size(wanted.count())
    maybe, _ = split_by_bitmap(docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(0)).alias(TMP + "id"), F.col(f"`{text_col}`").alias(TMP + "text")), F.xxhash64(TMP + "id"), bitmap_of(wanted, F.xxhash64("v"), bits), bits)
    sets = scratch(_sets(maybe, TMP + "id", TMP + "text", width), "sets")
    if sets.count() > sets.select("v", "d").distinct().count():  # rows that repeat both id and text
        sets = scratch(sets.dropDuplicates(["v", "d"]), "distinct-sets")
    star = _linked(led.where("c.k <> leader.k").select(F.col("c").alias("x"), F.col("leader").alias("y")).distinct(), sets, percent, "star")
    labels = scratch(components(star), "labels", settle=True)
    # Buckets that still hold two components, and their members but the leader.
    placed = led.join(labels.withColumnRenamed("v", "lk"), F.col("c.k") == F.col("lk"), "left").select("bucket", "c", "leader", F.coalesce("root", "c.k").alias("root"))
    placed = scratch(placed, "placed", settle=True)
    mixed = placed.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("members")).where("lo <> hi and members > 2").select("bucket", "members")
    mixed = scratch(mixed, "mixed", settle=True)
    if mixed.isEmpty():
        release(docs.sparkSession, before, star)
        return star, star.limit(0)
    still_open = lookup(placed.where("c.k <> leader.k").select("bucket", "c", "root"), mixed, "bucket", "members", total, "inner").select("c", "root").distinct()
    still_open = scratch(still_open, "open", settle=True)
    met = _linked(_prefix_pairs(sets, still_open, percent), sets, percent, "met")
    release(docs.sparkSession, before, star, met)
    return star, met


def _sketched(docs: DataFrame, percent: int, width: int, bands: int, rows: int, id_col: str, text_col: str) -> DataFrame:
    """One row per row of ``docs``: ``id, n, d1, component_id, first``; ``first`` marks the
    rows of the text that a component keeps."""
    ship_package(docs.sparkSession)
    before = written_tables(docs.sparkSession)
    sketches = scratch(_sketches(docs, id_col, text_col, width, bands, rows), "sketches")
    grouped = sketches.where("n > 0").groupBy("d1", "d2").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first(F.struct("n", "bands")).alias("s"))
    classes = scratch(grouped.select(F.monotonically_increasing_id().alias("k"), "d1", "d2", "id", "copies", "s.n", "s.bands"), "classes")
    links, more = _links(docs, classes.select("k", F.coalesce("id", F.lit(0)).alias("v"), F.col("d1").alias("d"), "n", "bands"), id_col, text_col, width, percent)
    if not more.isEmpty():
        links = scratch(links.unionAll(more), "all-links", settle=True)
    labels = scratch(components(links), "components", settle=True)
    # A component goes by its smallest id, a null id last; of several texts with that id the smallest digest stays.
    light = classes.select("k", "d1", "d2", "id", "copies")
    parts = labels.select(F.col("v").alias("k"), "root").unionAll(labels.select(F.col("root").alias("k"), "root").distinct()).join(light, "k")
    parts = scratch(parts, "parts", settle=True)
    heads = parts.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "d1", "d2", "k")).alias("head"), F.count(F.lit(1)).alias("texts"))
    heads = scratch(heads, "heads", settle=True)
    named = lookup(parts.select("k", "root"), heads, "root", "texts", parts.count(), "inner").select("k", F.col("head.id").alias("component"), (F.col("k") == F.col("head.k")).alias("first"))
    of_class = light.join(scratch(named, "named", settle=True), "k", "left")
    of_class = scratch(of_class.select("d1", "d2", "copies", F.coalesce("component", "id").alias("component"), F.coalesce("first", F.lit(True)).alias("first")), "class-components", settle=True)
    release(docs.sparkSession, before, sketches, of_class)
    found = sketches.where("n > 0").select("id", "n", "d1", "d2")
    found = lookup(found, of_class, ("d1", "d2"), "copies", sketches.count(), "inner")
    found = found.select("id", "n", "d1", F.col("component").alias("component_id"), (F.col("first") & F.col("id").eqNullSafe(F.col("component"))).alias("first"))
    return found.unionAll(sketches.where("n = 0").select("id", "n", "d1", F.col("id").alias("component_id"), F.lit(True).alias("first")))


def near_duplicates(docs: DataFrame, percent: int = 80, width: int = 5, bands: int = BANDS, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    * Words are lower-cased (A-Z) and end at ASCII white space. The set of a text is
      its distinct shingles of ``width`` words, hashed to 64 bits; with fewer words
      the whole sequence is one shingle. A null text, or one without words, has the
      empty set and is linked with nothing.
    * Texts are linked at a Jaccard similarity of ``percent`` / 100 or more of the
      full sets. ``component_id`` is the smallest id that can be reached;
      ``kept`` is ``doc_id <=> component_id``. Ids are taken as whole numbers.
    * Texts are told apart by their sets, not by their ids: rows that repeat an id with
      different texts are linked each on their own, and two of them in one component
      are both kept if the id is its smallest. Rows that repeat an id and text get the
      same row each.
    * A null id is the smallest of no component, unless all its ids are null; then the
      component's id is null. Other columns are ignored; an empty table gives an empty
      result.
    """
    found = _sketched(docs, percent, width, bands, rows, id_col, text_col)
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, percent: int = 80, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one text of each component, all columns unchanged.

    The text with the smallest id stays, null ids last; of texts with one id the one
    with the smallest digest. Rows that repeat an id and text stay or go together; texts
    without words stay. The ids of what goes are put into a bit map of fixed size: rows
    that are surely not among them pass without a shuffle, the others are looked up by
    id and digest."""
    gone, gone_id, gone_d = TMP + "gone", TMP + "gone_id", TMP + "gone_d"
    dropped = _sketched(docs, percent, width, BANDS, ROWS, id_col, text_col).where("not first").select(F.coalesce("id", F.lit(0)).alias(gone_id), F.col("d1").alias(gone_d))
    dropped = scratch(dropped.distinct(), "dropped", settle=True)
    bits = bitmap_size(dropped.count())
    columns = [F.col(f"`{c}`") for c in docs.columns]
    key = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(0))

    def work():
        shingle = _shingler(width)
        return lambda texts: [_digest(shingle(t))[0] for t in texts]  # null without words: such texts stay

    maybe, stays = split_by_bitmap(docs, F.xxhash64(key), bitmap_of(dropped, F.xxhash64(gone_id), bits), bits)
    digest = maybe.withColumn(gone, text_udf("long", work)(F.col(f"`{text_col}`")))
    return stays.select(*columns).unionAll(digest.join(dropped, (key == F.col(gone_id)) & (F.col(gone) == F.col(gone_d)), "left_anti").select(*columns))

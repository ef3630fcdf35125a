"""N-gram Jaccard join by vertical partitioning.

A document's set is its distinct shingles of ``n`` words.  Equal sets are one class, joined
through its smallest doc_id.  All shingles are counted over the classes; the global order is
by (count, hash), rarest first.  A shingle that only one class has overlaps nothing, so a
class with too many of these is out, and of the rest only the shared shingles go on.  The
global order is cut into fragments at its quantiles; a pair's overlap is counted in every
fragment on its own and summed per pair.  Candidate pairs share a shingle of their prefixes.

A group that shares a shingle isn't paired with itself: each member first meets the one with
the fewest shingles of its own, links are united, and only members whose components still
differ meet after that.  So no link between components is lost, and a group of near copies
costs a pair a member.  A pair meets at a shared shingle only if what both have from there on
in the global order can reach the threshold.  Shingles are 64-bit hashes, and overlaps are
counted on all 64 bits.

Cases: texts with fewer words than ``n`` have the whole sequence as their one shingle; texts
without words and nulls have none and link with nothing; texts of any length are taken
whole; equal rows with one doc_id count once, wherever in the table they are, and of unlike
texts under one doc_id that are the first of their classes, the one with the smallest set
hash stands for the doc_id in links; a null doc_id links with nothing; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm import counting, parts
from tollgate.llm.components import components
from tollgate.llm.tables import arrow_map, kept, rows, steady
from tollgate.llm.words import blocks, grams, group_order, inside, mix, sums, words

FRAGMENTS = 12


def shingles(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, text after text, and where each text's begin, and the end."""
    w = words(texts, lower=True)
    h, docs = w.hashes(), len(w.offsets) - 1
    ok = inside(w.first, n)
    value, doc = grams(h, n)[ok], w.texts()[: len(ok)][ok]
    short = np.flatnonzero((w.counts > 0) & (w.counts < n))
    if len(short):
        whole = []
        for a, b in zip(w.first[short].tolist(), w.first[short + 1].tolist()):
            whole.append(int(grams(h[a:b], b - a, 1000 + b - a)[0]))
        value, doc = np.concatenate((value, np.array(whole, np.uint64))), np.concatenate((doc, short))
    order, head = group_order(mix(value ^ mix(doc.astype(np.uint64), 41), 43))
    some = order[head]
    value, doc = value[some], doc[some]
    bits = max(1, docs.bit_length())
    by_doc = (np.sort((doc.astype(np.uint64) << np.uint64(40)) | np.arange(len(doc), dtype=np.uint64)) & np.uint64((1 << 40) - 1)).astype(np.int64) if bits < 24 else np.argsort(doc, kind="stable")
    return value[by_doc], np.searchsorted(doc[by_doc], np.arange(docs + 1))


def _set_hashes(block: pa.RecordBatch, n: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    value, first = shingles(block.column("text"), n)
    return pa.array(np.diff(first)), *(pa.array(sums(mix(value, seed).view(np.int64), first)) for seed in (51, 53))


def classes(docs: DataFrame, n: int, seen: str) -> DataFrame:
    """doc_id, n_shingles, a, b (of the set's hash), part (of docs), class_id: the smallest doc_id with an equal set; null for a document without shingles."""

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for block in blocks(batch):
            count, a, b = _set_hashes(block, n)
            yield rows(doc_id=block.column("doc_id"), n_shingles=count, a=a, b=b, part=pa.array(np.full(block.num_rows, parts.here()), pa.int32()))

    sets = kept(arrow_map(docs, parts.guarded(each, seen), "doc_id long, n_shingles long, a long, b long, part int", whole=True), "sets")
    same = sets.where("n_shingles > 0").groupBy("a", "b", "n_shingles").agg(F.min("doc_id").alias("class_id"))
    same = kept(same, "same")  # both sides of the join are plain exchanges, so that a large class is split
    return sets.join(same, ["a", "b", "n_shingles"], "left").select("doc_id", "n_shingles", "a", "b", "part", "class_id")


def _firsts_of(block: pa.RecordBatch, ids: np.ndarray) -> pa.RecordBatch:
    """The rows of a block whose doc_id is among the ascending ids, and those that stand for a repeated one."""
    own = block.column("doc_id").fill_null(0).to_numpy()
    there = block.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
    return block.filter(pa.array((parts.among(own, ids) & there) | block.column("once").to_numpy(zero_copy_only=False)))


def _once(docs: DataFrame, classed: DataFrame, n: int, seen: str) -> tuple[DataFrame, str, str]:
    """doc_id, text, once; what ``parts.witnessed`` of them; and a path of doc_ids by part: their rows, and those with ``once``, are a row for each first of a class over the whole table."""
    known = classed.where("doc_id is not null")
    ids = known.groupBy("doc_id").agg(F.count("*").alias("times"), F.max(F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(False))).alias("first"), F.min("part").alias("part"))
    ids = kept(ids.where("first").select("doc_id", "times", "part"), "ids")
    single = parts.write(ids.where("times = 1").select("part", "doc_id"), "firsts")
    docs = docs.select("doc_id", "text", F.lit(False).alias("once"))
    if ids.where("times > 1").isEmpty():
        return docs, seen, single
    again = parts.write(known.join(ids.where("times > 1").select("doc_id"), "doc_id", "left_semi").select("part", "doc_id").distinct(), "again")

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for block in blocks(batch):
            block = _firsts_of(block, parts.longs(again, "doc_id"))
            _, a, b = _set_hashes(block, n)
            yield rows(doc_id=block.column("doc_id"), text=block.column("text"), a=a, b=b)

    # only texts of repeated ids are shuffled, one for each set and task
    one = arrow_map(docs, parts.guarded(each, seen), "doc_id long, text string, a long, b long", whole=True).groupBy("doc_id", "a", "b").agg(F.min("text").alias("text"))
    chosen = known.where("doc_id = class_id").groupBy("doc_id").agg(F.min(F.struct("a", "b")).alias("set")).select("doc_id", "set.a", "set.b")
    one = kept(one.join(chosen, ["doc_id", "a", "b"], "left_semi").select("doc_id", "text", F.lit(True).alias("once")), "once")
    both = docs.union(one)
    return both, parts.witnessed(both), single  # a union's first partitions are those of docs


def _shared(docs: DataFrame, n: int, percent: int, firsts: str, seen: str) -> DataFrame:
    """doc_id, n, u (shingles that no other class has), order (hashes of the others by count and hash), cut (what the order is cut by) of classes that can link."""
    ranges = counting.ranges(docs)

    def read(block: pa.RecordBatch) -> tuple[pa.RecordBatch, np.ndarray, np.ndarray]:
        block = _firsts_of(block, parts.longs(firsts, "doc_id"))
        return block, *shingles(block.column("text"), n)

    answers = counting.answered(docs, lambda block: read(block)[1], ranges, "shingles", seen)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = counting.Answers(answers, ranges)
        for k, block in enumerate(block for batch in batches for block in blocks(batch, size=counting.ASKS)):
            block, value, first = read(block)
            count = asked.counts(k, value)
            hit, total = count > 1, np.diff(first)
            alone = sums(~hit, first)
            # the best partner has all the others and nothing else
            can = np.flatnonzero((100 * (total - alone) >= percent * total) & (total > 0))
            order, cut = [], []
            for d in can.tolist():
                some = np.flatnonzero(hit[first[d] : first[d + 1]]) + first[d]
                some = some[np.lexsort((value[some], count[some]))]
                order.append(value[some].view(np.int64))
                # ascends with the order: the count, then the first bits of the hash; shingles of the highest counts are cut together
                most = (1 << 23) - 1
                cut.append(np.where(count[some] < most, (count[some] << 40) | (value[some] >> np.uint64(24)).astype(np.int64), most << 40))
            yield rows(doc_id=block.column("doc_id").take(pa.array(can)), n=pa.array(total[can], pa.int64()), u=pa.array(alone[can], pa.int64()), order=pa.array(order, pa.list_(pa.int64())), cut=pa.array(cut, pa.list_(pa.int64())))

    return kept(arrow_map(docs, parts.guarded(each, seen, whole=True), "doc_id long, n long, u long, `order` array<long>, cut array<long>", whole=True), "shared")


def _to(edge: int):
    return lambda x: x <= F.lit(edge)


def overlaps(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """a, b, overlap: partial overlaps in every fragment, summed per pair."""
    left = segments.select(F.col("doc_id").alias("a"), "fragment", F.col("part").alias("x"))
    right = segments.select(F.col("doc_id").alias("b"), "fragment", F.col("part").alias("y"))
    partial = pairs.join(left, "a").join(right, ["b", "fragment"])
    return partial.groupBy("a", "b").agg(F.sum(F.size(F.array_intersect("x", "y"))).alias("overlap"))


def links(docs: DataFrame, classed: DataFrame, n: int, percent: int, seen: str, fragments: int = FRAGMENTS) -> DataFrame:
    """id, component of class ids that are linked with another."""
    once, seen, firsts = _once(docs, classed, n, seen)
    shared = _shared(once, n, percent, firsts, seen)
    # cut the global order at its quantiles
    cuts = shared.select(F.explode("cut").alias("o"))
    bounds = sorted({int(x) for x in cuts.approxQuantile("o", [i / fragments for i in range(1, fragments)], 0.02)}) if fragments > 1 else []
    edges = [-1, *bounds, (1 << 63) - 1]
    upto = {e: F.size(F.filter("cut", _to(e))) for e in edges}
    at = shared.select("doc_id", "order", *[upto[e].alias(f"upto{i}") for i, e in enumerate(edges)])
    part = lambda i: F.slice("order", F.col(f"upto{i}") + 1, F.col(f"upto{i + 1}") - F.col(f"upto{i}"))
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("fragment"), part(i).alias("part")) for i in range(len(edges) - 1)]))
    segments = kept(at.select("doc_id", each.alias("s")).select("doc_id", "s.fragment", "s.part").where(F.size("part") > 0), "segments")
    sizes = shared.select("doc_id", "n", "u")
    # the prefix of the whole set begins with the u shingles of its own
    length = F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100) + 1 - F.col("u")
    prefix = F.posexplode(F.slice("order", F.lit(1), length.cast("int"))).alias("i", "o")
    posts = kept(shared.where(length > 0).select("doc_id", "n", "u", prefix).select("doc_id", "n", (F.col("u") + F.col("i")).alias("before"), "o"), "posts")

    def enough(x: str, y: str):
        """Whether two sets can reach the threshold if a shingle is the rarest that both have: none before it counts."""
        most = F.least(F.col(f"{x}.n") - F.col(f"{x}.before"), F.col(f"{y}.n") - F.col(f"{y}.before"))
        return (100 + percent) * most >= F.lit(percent) * (F.col(f"{x}.n") + F.col(f"{y}.n"))

    def verified(pairs: DataFrame) -> DataFrame:
        both = overlaps(pairs, segments).join(sizes.select(F.col("doc_id").alias("a"), F.col("n").alias("m")), "a").join(sizes.select(F.col("doc_id").alias("b"), "n"), "b")
        return both.where(F.lit(100) * F.col("overlap") >= F.lit(percent) * (F.col("m") + F.col("n") - F.col("overlap"))).select("a", "b")

    middle = posts.groupBy("o").agg(F.min(F.struct("before", "doc_id", "n")).alias("y"), F.count("*").alias("times")).where("times > 1").select("o", "y")
    star = posts.alias("x").join(middle, "o").where((F.col("x.doc_id") != F.col("y.doc_id")) & enough("x", "y"))
    star = kept(star.select(F.least("x.doc_id", "y.doc_id").alias("a"), F.greatest("x.doc_id", "y.doc_id").alias("b")).distinct(), "star")
    found = kept(verified(star), "links")
    label = kept(components(found), "components")
    named = posts.join(label.withColumnRenamed("id", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    # groups that still have two components or more, and in them the members outside the largest
    sizes_ = named.groupBy("o", "component").agg(F.count("*").alias("members"))
    major = sizes_.groupBy("o").agg(F.max(F.struct("members", "component")).alias("most"), F.count("*").alias("kinds")).where("kinds > 1").select("o", F.col("most.component").alias("major"))
    open_ = kept(named.join(major, "o"), "open")
    x, y = open_.where("component <> major").alias("x"), open_.alias("y")
    rest = x.join(y, "o").where((F.col("x.component") != F.col("y.component")) & enough("x", "y"))
    rest = rest.select(F.least("x.doc_id", "y.doc_id").alias("a"), F.greatest("x.doc_id", "y.doc_id").alias("b")).distinct().join(star, ["a", "b"], "left_anti")
    more = kept(verified(kept(rest, "rest")), "links")
    return components(found.union(more))


def join(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id of every document; ``percent`` is the least Jaccard similarity of a link, times 100."""
    docs = steady(docs.select("doc_id", "text"))
    seen = parts.witnessed(docs)
    classed = kept(classes(docs, n, seen), "classes")
    grouped = links(docs, classed, n, percent, seen).select(F.col("id").alias("class_id"), "component")
    out = classed.join(grouped, "class_id", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "class_id", "doc_id")).alias("component_id"))



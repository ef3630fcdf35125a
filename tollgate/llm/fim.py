"""Fill-in-middle transformation by a parallel automaton scan.

A text is cut into units, here lines with their ends, and its prefix, middle and suffix are
whole units, chosen by a hash of its doc_id.  One automaton counts units and notices the
sentinels.  A text of up to ``CHUNK`` bytes is scanned where it is.  A giant one is dealt out
in chunks: every chunk is scanned from each state and gives a state transition function and
a count for each state; functions are composed ``FAN`` at a time up a tree, the tree is
walked down to learn in which state and after how many units every chunk begins, and only
the chunks that hold a cut are scanned again for its place.  No task ever has more than
``FAN`` functions of one text, and a giant text meets its cuts again in one join.

Cases: a null text is empty; an empty text, and one that has a sentinel in it, stay plain, with
0 or all of their units counted; texts of any length are taken whole; a null doc_id hashes as
an empty one; equal rows give equal results, as often as they occur; an empty table gives no
rows; other columns stay only if asked for, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.llm.automata import Automaton, scan, units_and_marks
from tollgate.llm.tables import arrow_map, kept, rows
from tollgate.llm.words import blocks, buffers

PREFIX, SUFFIX, MIDDLE = SENTINELS = ("<P>", "<S>", "<M>")
CHUNK = 1 << 16
FAN = 256
OWN = "__fim_"  # before the names of this module's own columns, so that others' don't clash


def _hash(group: int, seed: int) -> Column:
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"{OWN}id").cast("string"), F.lit("")))
    return F.conv(F.substring(F.sha2(text.cast("binary"), 256), 8 * group + 1, 8), 16, 10).cast("long")


def lines() -> Automaton:
    return units_and_marks(10, [s.encode() for s in SENTINELS])


def _cut_points(h1: np.ndarray, h2: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many units come before the middle, and before the suffix."""
    a, b = h1 % (n + 1), h2 % (n + 1)
    return np.minimum(a, b), np.maximum(a, b)


def _cut_here(docs: DataFrame, columns: list[str], automaton: Automaton) -> DataFrame:
    """Texts of one chunk each: n, found, and the bytes before the middle and before the suffix."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, f"{OWN}text"):
                got = scan(automaton, *buffers(block.column(f"{OWN}text")))
                state, count = (x[:, 0] for x in got.whole())
                n = count + automaton.inside[state]
                which, zero = np.arange(len(n)), np.zeros(len(n), np.int64)
                a, b = _cut_points(block.column(f"{OWN}h1").to_numpy(), block.column(f"{OWN}h2").to_numpy(), n)
                found = {"n": pa.array(n), "found": pa.array(automaton.found[state]), "a": pa.array(got.places(which, zero, a)), "b": pa.array(got.places(which, zero, b))}
                yield rows(**{c: block.column(c) for c in columns}, **{OWN + c: v for c, v in found.items()})

    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in columns), f"{OWN}n long", f"{OWN}found boolean", f"{OWN}a long", f"{OWN}b long"])
    return arrow_map(docs.select(*[f"`{c}`" for c in columns]), each, schema, whole=True)


def chunks(texts: DataFrame, automaton: Automaton, chunk: int) -> DataFrame:
    """key, chunk, data, ends, counts: the chunks of texts (key, text) and what each does to the automaton, by state."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            for key, a, b in zip(batch.column("key").to_pylist(), offsets.tolist(), offsets[1:].tolist()):
                starts = range(a, b, chunk)
                for i in range(0, len(starts), FAN):
                    some = starts[i : i + FAN]
                    yield rows(key=pa.array([key] * len(some)), chunk=pa.array(range(i, i + len(some)), pa.int64()), data=pa.array([data[s : min(s + chunk, b)].tobytes() for s in some], pa.binary()))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "data"):
                state, count = scan(automaton, *buffers(block.column("data"))).whole()
                yield rows(key=block.column("key"), chunk=block.column("chunk"), data=block.column("data"), ends=pa.array(state.astype(np.int32).tolist(), pa.list_(pa.int32())), counts=pa.array(count.tolist(), pa.list_(pa.int64())))

    dealt = arrow_map(texts, cut, "key string, chunk long, data binary", whole=True).repartition("key", "chunk")
    return arrow_map(dealt, summed, "key string, chunk long, data binary, ends array<int>, counts array<long>", whole=True)


def _grouped(level: DataFrame) -> DataFrame:
    """key, parent, members: functions in their order, ``FAN`` of one text at the most."""
    return level.groupBy("key", F.floor(F.col("chunk") / FAN).alias("parent")).agg(F.array_sort(F.collect_list(F.struct("chunk", "ends", "counts"))).alias("members"))


def composed(level: DataFrame, states: int) -> DataFrame:
    """The functions of ``FAN`` neighbours each as one: the next level of the tree."""
    same = F.struct(F.array(*[F.lit(s) for s in range(states)]).alias("ends"), F.array(*[F.lit(0).cast("long")] * states).alias("counts"))
    then = lambda f, g: F.struct(
        F.transform(f["ends"], lambda e: F.get(g["ends"], e)).alias("ends"), F.zip_with(f["counts"], f["ends"], lambda c, e: c + F.get(g["counts"], e)).alias("counts")
    )
    return _grouped(level).select("key", F.col("parent").alias("chunk"), F.aggregate("members", same, then).alias("f")).select("key", "chunk", "f.ends", "f.counts")


def entries(functions: DataFrame, states: int) -> DataFrame:
    """key, chunk, state, before, end, after: how every chunk is begun, and how it ends, when the text is begun in state 0."""
    levels = [functions]
    while (levels[-1].agg(F.max("chunk")).first()[0] or 0) >= FAN:  # one number
        levels.append(kept(composed(levels[-1], states), "functions"))
    begun = None
    walk = lambda done, f: F.concat(done, F.array(F.struct(f["chunk"].alias("chunk"), F.element_at(done, -1)["end"].alias("state"), F.element_at(done, -1)["after"].alias("before"), F.get(f["ends"], F.element_at(done, -1)["end"]).alias("end"), (F.element_at(done, -1)["after"] + F.get(f["counts"], F.element_at(done, -1)["end"])).alias("after"))))
    for level in reversed(levels):
        group = _grouped(level)
        group = group.withColumns({"state": F.lit(0), "before": F.lit(0).cast("long")}) if begun is None else group.join(begun.select("key", F.col("chunk").alias("parent"), "state", "before"), ["key", "parent"])
        start = F.array(F.struct(F.lit(-1).cast("long").alias("chunk"), F.lit(0).alias("state"), F.lit(0).cast("long").alias("before"), F.col("state").alias("end"), F.col("before").alias("after")))
        begun = kept(group.select("key", F.explode(F.aggregate("members", start, walk)).alias("e")).select("key", "e.*").where("chunk >= 0"), "entries")
    return begun


def _cut_apart(docs: DataFrame, columns: list[str], automaton: Automaton, chunk: int) -> DataFrame:
    """As ``_cut_here``, of giant texts."""
    states = len(automaton.move)
    docs = docs.withColumn(f"{OWN}key", F.sha2(F.concat(F.coalesce(F.col(f"{OWN}id").cast("string"), F.lit("")), F.lit(":"), F.col(f"{OWN}text")).cast("binary"), 256))
    pieces = kept(chunks(docs.select(F.col(f"{OWN}key").alias("key"), F.col(f"{OWN}text").alias("text")), automaton, chunk), "chunks")
    begun = entries(pieces.select("key", "chunk", "ends", "counts").dropDuplicates(["key", "chunk"]), states)
    flag = lambda values: F.get(F.array(*[F.lit(bool(v)) for v in values]), F.col("last.end"))
    last = begun.groupBy("key").agg(F.max(F.struct("chunk", "end", "after")).alias("last"))
    total = last.select("key", (F.col("last.after") + flag(automaton.inside).cast("long")).alias("n"), flag(automaton.found).alias("found"))
    hashes = docs.select(F.col(f"{OWN}key").alias("key"), F.col(f"{OWN}h1").alias("h1"), F.col(f"{OWN}h2").alias("h2"), F.octet_length(f"{OWN}text").cast("long").alias("bytes")).distinct()
    x, y = (F.col(h) % (F.col("n") + 1) for h in ("h1", "h2"))
    told = kept(total.join(hashes, "key").select("key", "n", "found", "bytes", F.least(x, y).alias("ka"), F.greatest(x, y).alias("kb")), "told")
    asked = told.select("key", F.explode(F.array(F.struct(F.lit("a").alias("cut"), F.col("ka").alias("k")), F.struct(F.lit("b").alias("cut"), F.col("kb").alias("k")))).alias("c")).select("key", "c.*")
    held = asked.join(begun, "key").where((F.col("before") < F.col("k")) & (F.col("k") <= F.col("after"))).select("key", "chunk", "cut", "state", (F.col("k") - F.col("before")).alias("k"))

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "data"):
                got = scan(automaton, *buffers(block.column("data")))
                place = got.places(np.arange(block.num_rows), block.column("state").to_numpy().astype(np.int64), block.column("k").to_numpy())
                yield rows(key=block.column("key"), cut=block.column("cut"), place=pa.array(block.column("chunk").to_numpy() * chunk + place))

    places = arrow_map(held.join(pieces.select("key", "chunk", "data"), ["key", "chunk"]).select("key", "chunk", "cut", "state", "k", "data"), select, "key string, cut string, place long", whole=True)
    by_key = places.groupBy("key").agg(F.max(F.when(F.col("cut") == "a", F.col("place"))).alias("a"), F.max(F.when(F.col("cut") == "b", F.col("place"))).alias("b"))
    # no chunk holds a cut before the first unit, nor one after an unfinished last one
    at = lambda c: F.coalesce(F.col(c), F.when(F.col(f"k{c}") == 0, F.lit(0).cast("long")).otherwise(F.col("bytes")))
    told = kept(told.join(by_key, "key", "left").select(F.col("key").alias(f"{OWN}key"), F.col("n").alias(f"{OWN}n"), F.col("found").alias(f"{OWN}found"), at("a").alias(f"{OWN}a"), at("b").alias(f"{OWN}b")), "cuts")
    return docs.join(told, f"{OWN}key").select(*[f"`{c}`" for c in columns], *(OWN + c for c in ("n", "found", "a", "b")))


def transform(docs: DataFrame, columns: tuple[str, ...] = (), seed: int = 7, rate: int = 100, spm: int = 50, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n (units), form (plain, psm or spm), output, other columns; rate and spm are percentages of texts that aren't plain, and of those with the suffix first."""
    automaton = lines()
    also = [f"{OWN}c{i}" for i in range(len(columns))]
    base = docs.select(F.col("doc_id").cast("long").alias(f"{OWN}id"), F.coalesce(F.col("text"), F.lit("")).alias(f"{OWN}text"), *[F.col(f"`{c}`").alias(a) for c, a in zip(columns, also)])
    base = base.withColumns({f"{OWN}h1": _hash(0, seed), f"{OWN}h2": _hash(1, seed)})
    names = [f"{OWN}id", f"{OWN}text", f"{OWN}h1", f"{OWN}h2", *also]
    small = F.octet_length(f"{OWN}text") <= chunk
    giants = base.where(~small)
    cut = _cut_here(base.where(small), names, automaton)
    if not giants.isEmpty():
        cut = cut.union(_cut_apart(giants, names, automaton, chunk))
    raw, a, b = (F.col(OWN + c) for c in ("text", "a", "b"))
    piece = lambda start, size: F.substring(raw.cast("binary"), start.cast("int") + 1, size.cast("int")).cast("string")
    prefix, middle, suffix = piece(F.lit(0), a), piece(a, b - a), piece(b, F.octet_length(raw) - b)
    form = F.when((raw == "") | F.col(f"{OWN}found") | (_hash(2, seed) % 100 >= rate), "plain").when(_hash(3, seed) % 100 < spm, "spm").otherwise("psm")
    p, s, m = map(F.lit, SENTINELS)
    out = cut.withColumn(f"{OWN}form", form)
    text = F.when(F.col(f"{OWN}form") == "plain", raw).when(F.col(f"{OWN}form") == "psm", F.concat(p, prefix, s, suffix, m, middle)).otherwise(F.concat(s, suffix, p, prefix, m, middle))
    return out.select(F.col(f"{OWN}id").alias("doc_id"), F.col(f"{OWN}n").alias("n"), F.col(f"{OWN}form").alias("form"), text.alias("output"), *[F.col(x).alias(c) for c, x in zip(columns, also)])


def pieces(output: Column, form: Column) -> dict[str, Column]:
    """prefix, middle and suffix, read from an output; null where it is plain."""
    at = F.split(output, "|".join(SENTINELS))
    first, second = F.get(at, F.lit(1)), F.get(at, F.lit(2))
    psm, cut = form == "psm", form != "plain"
    return {"prefix": F.when(cut, F.when(psm, first).otherwise(second)), "middle": F.when(cut, F.get(at, F.lit(3))), "suffix": F.when(cut, F.when(psm, second).otherwise(first))}


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of."""
    of = pieces(output, form)
    return F.when(form == "plain", output).otherwise(F.concat(of["prefix"], of["middle"], of["suffix"]))


def digest(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256."""
    out = transform(docs, **options)
    of = pieces(F.col("output"), F.col("form"))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return out.select("doc_id", "n", "form", F.char_length(of["prefix"]).cast("long").alias("prefix_chars"), F.char_length(of["middle"]).cast("long").alias("middle_chars"), sha(F.col("output")).alias("output_sha256"), sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


ORACLE = r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT doc_id, text, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS u, [CAST('0x' || substr(h, 8 * i + 1, 8) AS BIGINT) FOR i IN [0, 1, 2, 3]] AS h FROM d),
c AS (SELECT *, len(u) AS n, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS a, greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 100 THEN 'plain' WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS prefix, coalesce(array_to_string(u[a + 1:b], ''), '') AS middle, coalesce(array_to_string(u[b + 1:], ''), '') AS suffix FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256 FROM p"""

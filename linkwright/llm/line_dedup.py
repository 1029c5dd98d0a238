"""Fuzzy line dedup by MinHash of character shingles (operator 4, native).

Lines are the parts of a text between line feeds, normalised by lower-casing and
collapsing white space. Equal lines are one node. A line's set are its 8-character
shingles at every character; a shorter line is one. Each shingle is hashed once, and the
range of hashes is cut into ten equal parts (one-permutation MinHash, Li, Owen and Zhang,
2012): the four least hashes of a part make the key of one band. Bands find the
candidates, exact Jaccard similarity on the shingle sets (at least 0.8) confirms them,
distributed union-find makes components, and of each component the first line (by doc_id,
then line number) stays.

A pair at exactly 0.8 shares no band with probability 0.005; that is the recall of the
method.  All operations are DataFrame operations.  A line's hashes are an array of its
own row, sorted together with the ends of the parts, so that its keys need no shuffle and
no aggregation: only keys travel.  That array takes some 40 bytes for each character of
the line.  Lines are the same line if two 64-bit fingerprints are equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkwright.llm import nearlinks
from linkwright.llm.common import drop, stage, table

SHINGLE = 8
NUM, DEN = 80, 100
BANDS, ROWS = 10, 4
#: Where the parts of the hashes begin.
ENDS = [(1 << 64) * band // BANDS - (1 << 63) for band in range(BANDS)]
#: White space other than one space alone, on one line.
SPACE = r"[\t\x0B\f\r][ \t\x0B\f\r]*| [ \t\x0B\f\r]+"
#: Nodes with candidates that are broadcast at most (8 bytes each); beyond, a shuffle join.
MOST_NODES = 1_000_000


def lines(docs: DataFrame) -> DataFrame:
    """doc_id, line_no (from 0) and norm, the normalised line, of lines that are not blank."""
    text = F.regexp_replace(F.lower(F.col("text").cast("string")), SPACE, " ")
    parts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    return parts.select("doc_id", "line_no", F.trim("line").alias("norm")).where("norm <> ''")


def node(norm: Column) -> Column:
    return F.xxhash64(norm)


def check(norm: Column) -> Column:
    """A second fingerprint; the number before the line seeds it."""
    return F.xxhash64(F.lit(BANDS), norm)


def hashes(norm: Column) -> Column:
    """The hash of each shingle, in their order: SHINGLE characters from every character on, or the whole line.

    A character takes four bytes, so that its place is found without a walk.
    """
    begins = F.sequence(F.lit(1), F.greatest(F.length(norm) * 4 - (4 * SHINGLE - 1), F.lit(1)), F.lit(4))
    wide = F.array(F.encode(norm, "UTF-32"))  # encoded once
    return F.transform(wide, lambda w: F.transform(begins, lambda i: F.xxhash64(F.substring(w, i, F.lit(4 * SHINGLE)))))[0]


def shingle_set(norm: Column) -> Column:
    """The distinct hashes of its shingles."""
    return F.array_distinct(hashes(norm))


def signed(found: DataFrame) -> DataFrame:
    """doc_id, line_no, node, check and keys, a key for each band that has a hash; found: lines()."""
    ends = F.array(*[F.lit(e).cast("long") for e in ENDS])
    own = found.select("doc_id", "line_no", node(F.col("norm")).alias("node"), check(F.col("norm")).alias("check"), hashes(F.col("norm")).alias("h"))
    own = own.withColumn("h", F.sort_array(F.array_union("h", ends)))
    at = F.array(*[F.array_position("h", F.lit(e).cast("long")).cast("int") for e in ENDS], F.size("h") + 1)

    def key(band: Column) -> Column:
        begin, n = F.get("at", band), F.get("at", band + 1) - F.get("at", band) - 1
        return F.when(n > 0, F.xxhash64(band, F.slice("h", begin + 1, F.least(n, F.lit(ROWS)))))

    keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), key)
    return own.withColumn("at", at).select("doc_id", "line_no", "node", "check", F.filter(keys, lambda k: k.isNotNull()).alias("keys"))


def components_of(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The lines as (doc_id, line_no, node, check), and (node, check, component) of nodes that are linked."""
    known = stage(signed(lines(docs)), "lines")
    nodes = stage(known.select("node", "keys").dropDuplicates(["node"]), "nodes")
    members = stage(nearlinks.members(nodes.select("node", F.explode("keys").alias("key"))), "members")
    drop(nodes)
    asked = stage(members.select("node").distinct(), "asked")
    few = asked.count() <= MOST_NODES
    own = lines(docs).select(node(F.col("norm")).alias("node"), check(F.col("norm")).alias("check"), "norm")
    own = own.join(F.broadcast(asked) if few else asked, "node")
    # of different lines with one fingerprint the one with the least check stands for the node
    texts = stage(own.groupBy("node").agg(F.min(F.struct("check", "norm")).alias("m")).select("node", "m.check", F.col("m.norm").alias("items")), "texts", "zstd")
    linked = nearlinks.link(members, lambda _: texts.select("node", "items"), NUM, DEN, of=shingle_set, exact=True)
    labels = stage(linked.join(texts.select("node", "check"), "node"), "labels")
    drop(members, asked, texts)
    return known.select("doc_id", "line_no", "node", "check"), labels


def line_components(docs: DataFrame) -> DataFrame:
    """doc_id, line_no, first_doc, first_line, kept for each line that is not blank.

    A line is kept if it is the first of its component.  Null and empty texts have no such
    lines, blank lines are in no component and always stay.  Rows that repeat a doc_id have
    the same place: lines of either at the component's first place are kept.  Rows without
    doc_id come first.  An empty table gives an empty result; other columns are ignored.
    """
    found, labels = components_of(docs)
    by = ["node", "check"]
    times = found.groupBy(*by).agg(F.count("*").alias("n")).join(labels, by, "left")
    many = stage(times.where("n > 1 or component is not null").drop("n"), "many")  # the other lines have no equals
    first = found.join(many, by).groupBy(*by, "component").agg(F.min(F.struct("doc_id", "line_no")).alias("place"))
    linked = F.when(F.col("component").isNotNull(), F.struct(F.col("component").alias("node"), F.lit(0).cast("long").alias("check")))
    rooted = first.withColumn("component", F.coalesce(linked, F.struct(*by)))
    least = rooted.groupBy("component").agg(F.min("place").alias("least"))
    named = stage(rooted.join(least, "component").select(*by, F.col("least.doc_id").alias("d"), F.col("least.line_no").alias("l")), "named")
    drop(many)
    own = F.col("l").isNull()
    out = found.join(named, by, "left")
    kept = own | (F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("line_no") == F.col("l")))
    return out.select(
        "doc_id",
        "line_no",
        F.when(own, F.col("doc_id")).otherwise(F.col("d")).alias("first_doc"),
        F.when(own, F.col("line_no")).otherwise(F.col("l")).alias("first_line"),
        kept.alias("kept"),
    )


def cleaned(docs: DataFrame) -> DataFrame:
    """The rows of docs with the lines that are not kept taken out of text."""
    gone = line_components(docs).where("not kept").groupBy("doc_id").agg(F.collect_set("line_no").alias("_gone"))
    gone = gone.withColumnRenamed("doc_id", "_doc")
    joined = docs.join(gone, docs["doc_id"].eqNullSafe(gone["_doc"]), "left")
    parts = F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("_gone", i))
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(parts, "\n"))
    return joined.select(*[text.alias("text") if c == "text" else F.col(c) for c in docs.columns])


def op4_line_dedup(spark, sf_dir: str) -> DataFrame:
    """For each doc_id: the number of lines that are not blank, how many go, and which (numbers, in order).

    A document without such lines, its text null or empty, has none; rows that repeat a
    doc_id count together, as do rows without one.
    """
    docs = table(spark, sf_dir, "documents")
    found = line_components(docs).select("doc_id", "line_no", "kept")
    every = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("int").alias("line_no"), F.lit(True).alias("kept"))
    found = stage(found.unionByName(every), "judged")
    counts = found.groupBy("doc_id").agg(F.count("line_no").alias("n_lines"), F.count_if(~F.col("kept")).alias("n_removed"))
    gone = found.where("not kept").groupBy(F.col("doc_id").alias("d")).agg(F.array_join(F.array_sort(F.collect_list("line_no")), ",").alias("gone"))
    out = counts.join(gone, F.col("doc_id").eqNullSafe(F.col("d")), "left")
    return out.select("doc_id", "n_lines", "n_removed", F.coalesce("gone", F.lit("")).alias("removed_lines"))

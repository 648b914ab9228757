"""Knowledge graphs as edge tables ``source, target, edge``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerleaf.functions import text as tx
from ledgerleaf.operators.frame import lookup_join
from ledgerleaf.session import checkpointed

# A run of capitalised words; letters of any alphabet.
NAME_SPAN = r"\p{Lu}[\p{Ll}]+(?: \p{Lu}[\p{Ll}]+)*"


def entity_edges(spans: DataFrame, key: str) -> DataFrame:
    """Document → entity edges labelled with the entity type; parallel edges stay."""
    return spans.select(
        F.col(key).cast("string").alias("source"), F.col("entity").alias("target"), F.col("entity_type").alias("edge")
    )


def facet(edges: DataFrame, value: str | None = None) -> DataFrame:
    return edges if value is None else edges.where(F.col("edge") == value)


def nodes(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("source", "target")).alias("node")).distinct()


def weighted_edges(edges: DataFrame) -> DataFrame:
    """Parallel edges collapsed, their number kept as ``n``."""
    return edges.groupBy("source", "target", "edge").agg(F.count("*").alias("n"))


def neighbours(edges: DataFrame) -> DataFrame:
    """Distinct ``node, neighbour`` pairs in both directions."""
    ends = F.array(
        F.struct(F.col("source").alias("node"), F.col("target").alias("neighbour")),
        F.struct(F.col("target").alias("node"), F.col("source").alias("neighbour")),
    )
    return edges.select(F.inline(ends)).distinct()


def degrees(edges: DataFrame) -> DataFrame:
    return neighbours(edges).groupBy("node").agg(F.count("*").alias("degree"))


def _page(neighbour: Column, pages: Column) -> Column:
    """A page number that depends on the neighbour only, so that pages fill evenly."""
    return F.conv(F.substring(F.md5(neighbour), 1, 8), 16, 10).cast("bigint") % pages


def adjacency_titles(edges: DataFrame, page_size: int = 500, heading: str = ": ", separator: str = "; ") -> DataFrame:
    """``node, page, degree, title``: every node with the text that lists its neighbours.

    The list of a node is dealt to ``degree / page_size`` pages, rounded up, so no task holds a hub's whole list.
    """
    pairs = checkpointed(neighbours(edges))
    sizes = checkpointed(pairs.groupBy("node").agg(F.count("*").alias("degree")))
    marked = lookup_join(pairs, sizes, "node", F.col("neighbour"))
    pages = F.ceil(F.col("degree") / F.lit(page_size)).cast("bigint")
    paged = marked.withColumn("page", _page(F.col("neighbour"), pages))
    listed = paged.groupBy("node", "degree", "page").agg(F.array_sort(F.collect_list("neighbour")).alias("_n"))
    title = F.concat(F.col("node"), F.lit(heading), F.array_join("_n", separator))
    return listed.select("node", "page", "degree", title.alias("title"))


def connected_parts(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (``a, b``, whole numbers): the smallest node that can be reached.

    In turn every node's larger neighbours, then its smaller ones, are linked to the smallest node it knows, until
    all nodes are linked to a root directly. Each round is materialised; the number of rounds grows with the logarithm of the nodes.
    """
    links = links.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).where("node <> root")
    links = checkpointed(links.distinct())
    while True:
        both = links.unionByName(links.select(F.col("root").alias("node"), F.col("node").alias("root")))
        least = both.groupBy("node").agg(F.least(F.min("root"), F.col("node")).alias("least"))
        large = both.join(least, "node").where("root > node").select(F.col("root").alias("node"), F.col("least").alias("root"))
        large = checkpointed(large.where("node <> root").distinct())
        least = large.groupBy("node").agg(F.min("root").alias("least"))
        small = large.join(least, "node").where("root <> least").select(F.col("root").alias("node"), F.col("least").alias("root"))
        after = checkpointed(small.unionByName(least.select("node", F.col("least").alias("root"))).distinct())
        roots = after.select(F.col("root").alias("node")).distinct()
        settled = after.join(roots, "node", "left_semi").isEmpty() and after.groupBy("node").count().where("count > 1").isEmpty()
        links = after
        if settled:
            return links.unionByName(roots.select("node", F.col("node").alias("root")))


def triples(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, sent_no, source, edge, target`` per sentence.

    The first and the last name span of a sentence are its entities; up to four
    words after the first, before the last, are the relation. What a sentence
    lacks is empty, and nothing carries over to the next one.
    """
    rows = tx.unfolded(docs, [key], tx.sentences(F.col(text)), "sent_no", "sentence")
    rows = rows.withColumn("_m", tx.match_spans(F.col("sentence"), NAME_SPAN))
    count = F.size("_m")
    first, last = F.try_element_at("_m", F.lit(1)), F.try_element_at("_m", F.lit(-1))
    between = tx.span_at(F.col("sentence"), first["end"], last["start"])
    words = F.filter(F.split(F.regexp_replace(between, r"[^\p{L}]+", " "), " "), lambda w: w != "")
    return rows.select(
        key,
        "sent_no",
        F.when(count >= 1, first["entity"]).otherwise("").alias("source"),
        F.when(count >= 2, F.array_join(F.slice(words, 1, 4), " ")).otherwise("").alias("edge"),
        F.when(count >= 2, last["entity"]).otherwise("").alias("target"),
    )

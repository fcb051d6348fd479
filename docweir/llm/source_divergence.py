"""How far the sources of a language differ in the words they use."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweir.storage import materialize

#: What stands between terms, which are runs of ASCII letters and all that is not ASCII.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: A part in so many is one unit of a share.
UNITS = 1_000_000_000
#: What is added to every count, so that no share is zero.
PRIOR = 5
#: Parts that the vocabulary of one language is dealt to.
SPREAD = 64


def _lowered(text: Column) -> Column:
    """With A-Z in lower case and all else as it is; a text of ASCII characters alone takes the quick way."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, ascii_uppercase, ascii_lowercase))


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of a term, and documents that hold it; the term '' stands for the documents.

    A document's terms lie sorted beside themselves, moved on by one, so that the first of
    equal ones is known without a shuffle. The blank before a text gives every document an
    empty term.
    """
    parts = [F.coalesce(F.col(c), F.lit("")) for c in ("lang", "source", "text")]
    terms = F.sort_array(F.split(_lowered(F.concat(F.lit(" "), parts[2])), BETWEEN))
    listed = docs.select(parts[0].alias("lang"), parts[1].alias("source"), terms.alias("terms"))
    before = F.concat(F.array(F.lit(None).cast("string")), F.slice("terms", F.lit(1), F.size("terms") - 1))
    # An outer generator: for others the engine filters rows by the size of their list, for which it makes all lists twice.
    placed = listed.select("lang", "source", F.inline_outer(F.arrays_zip("terms", before)).alias("term", "before"))
    first = ~F.col("term").eqNullSafe(F.col("before"))
    return placed.groupBy("lang", "source", "term").agg(F.count(F.lit(1)).alias("n"), F.sum(first.cast("int")).alias("docs"))


def _share(n: str, total: str) -> Column:
    """1 + floor(UNITS * (n + PRIOR) / (total + PRIOR * v)), exact for all counts that a long holds."""
    return F.expr(f"1 + (CAST({n} + {PRIOR} AS DECIMAL(20, 0)) * {UNITS}) div ({total} + {PRIOR} * v)")


def kept_terms(counts: DataFrame, min_docs: int) -> DataFrame:
    """(lang, term, q): terms in ``min_docs`` documents of a language or more, and their share in it."""
    kept = counts.where("term != ''").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n")).where(F.col("docs") >= min_docs)
    totals = kept.groupBy("lang").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("v"))
    return kept.join(totals, "lang").select("lang", "term", _share("n", "total").alias("q"))


def dense_shares(groups: DataFrame, occurring: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, term, n, p, q): every group's share of every term that its language keeps.

    ``occurring`` has the counts of kept terms. A language may be that of most groups and
    terms, so both are dealt to parts of the vocabulary before they meet.
    """
    sums = occurring.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    sized = groups.join(sums, ["lang", "source"], "left").join(sizes, "lang").withColumn("total", F.coalesce("total", F.lit(0)))
    parts = sized.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    return (
        kept.withColumn("part", F.pmod(F.xxhash64("term"), F.lit(SPREAD)).cast("int"))
        .join(parts, ["lang", "part"])
        .join(occurring, ["lang", "source", "term"], "left")
        .withColumn("n", F.coalesce("n", F.lit(0)))
        .select("lang", "source", "term", "n", _share("n", "total").alias("p"), "q")
    )


def source_divergence(docs: DataFrame, min_docs: int = 30, top: int = 50) -> DataFrame:
    """(lang, source, part, item, value, rank) of every group, which is a source in a language.

    Part ``pair``: each other source of the language and the summed difference of the
    shares of all kept terms, largest first. Part ``term``: up to ``top`` terms that the
    group uses more than its language does, by how much. A term is a run of ASCII letters,
    lower-cased, and characters that are not ASCII; a language keeps those in ``min_docs``
    of its documents or more. A share is counted in units of 1 / 1,000,000,000, of counts
    to each of which 5 is added, in whole numbers only.

    Null texts, languages and sources count as empty. Texts of any length are read whole.
    Repeated rows count as often as they come; ties go to the item that comes first by its
    bytes. A group without terms has pairs; a language that keeps no term has pairs with
    value 0; a language with one source has none. Other columns are ignored; an empty
    table gives an empty result.

    Texts are read once and become counts, in each task before anything is shuffled, so a
    source or a term of most rows moves once per task. What follows grows with the groups
    and the vocabulary only; a term is met by all pairs of the sources of its language,
    which is as many rows as the result needs summed.
    """
    counts = materialize(term_counts(docs), "divergence-counts")
    groups = materialize(counts.where("term = ''").select("lang", "source"), "divergence-groups")
    kept = materialize(kept_terms(counts, min_docs), "divergence-terms")
    occurring = materialize(counts.join(kept.select("lang", "term"), ["lang", "term"], "left_semi").select("lang", "source", "term", "n"), "divergence-occurring")
    dense = materialize(dense_shares(groups, occurring, kept), "divergence-shares")
    # The empty term, the same to all, makes pairs in languages that keep no term.
    shares = dense.select("lang", "term", "source", "p").union(groups.select("lang", F.lit(""), "source", F.lit(0)))
    left, right = (shares.select("lang", "term", F.col("source").alias(s), F.col("p").alias(p)) for s, p in (("a", "p_a"), ("b", "p_b")))
    apart = (
        left.join(right, ["lang", "term"])
        .where("a < b")
        .groupBy("lang", "a", "b")
        .agg(F.sum(F.abs(F.col("p_a") - F.col("p_b"))).alias("value"))
    )
    both = F.array(*[F.struct(F.col(s).alias("source"), F.col(i).alias("item")) for s, i in (("a", "b"), ("b", "a"))])
    pairs = apart.select("lang", F.inline(both), "value")
    over = dense.where("n > 0 AND p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        rank = F.expr("row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)")
        return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", rank.alias("rank"))

    return ranked(pairs, "pair").union(ranked(over, "term").where(F.col("rank") <= top))

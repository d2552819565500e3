"""Secret scan with corpus-wide ownership frequency.

Three fixed patterns give the base spans: assignments, access keys and long hex
strings. A broader pattern gives further candidates: long mixed tokens. Every
candidate value is then counted over the corpus by distinct repositories and
owners. A value that several owners have is a copied example; so is one that a
single owner has in more than LIVE_REPOSITORIES repositories or LIVE_DOCUMENTS documents:
it is pasted about, not kept. Any other looks live. The base spans stay either way; a mixed
token is added as a span of kind ``token`` only if it looks live.

Counting goes by (value, owner, repository), then (value, owner), then value,
each combined before its shuffle, so a value in a third of all documents is no
hot group. Only values that repeat are joined back, spread over salts.

DataFrame functions only. Null text is empty and has no spans. A null owner is an
owner of its own, and so is a null repository. Rows are documents, also with
equal or null ids. Columns with other names are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratescape.llm import spans
from ratescape.llm.common import lookup, stored

#: The kinds, their patterns and smallest lengths.
KEY = "(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
ASSIGN = KEY + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS, HEX = "AKIA[A-Z0-9]+", "[0-9a-f]{24,}"
#: Mixed tokens: upper and lower case letters and digits, 24 or more characters.
MIXED = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]*[0-9])(?=[A-Za-z0-9+/_-]*[A-Z])(?=[A-Za-z0-9+/_-]*[a-z])[A-Za-z0-9+/_-]{24,}"
KINDS = ("assign", "access", "hex", "token")
#: Distinct characters that a mixed token has at least.
MIXED_CHARACTERS = 12
#: Owners, repositories and documents that a value which looks live has at most.
LIVE_OWNERS, LIVE_REPOSITORIES, LIVE_DOCUMENTS = 1, 2, 100


def base_spans(text: Column) -> Column:
    assign = F.filter(spans.find(text, ASSIGN, "assign", 0, group=1), lambda s: F.length(s["value"]) >= 6)
    access = F.filter(spans.find(text, ACCESS, "access", 1), lambda s: F.length(s["value"]) >= 20)
    return F.concat(assign, access, spans.find(text, HEX, "hex", 2))


def mixed_spans(text: Column) -> Column:
    varied = lambda s: F.size(F.array_distinct(F.split(s["value"], ""))) >= MIXED_CHARACTERS
    return F.filter(spans.find(text, MIXED, "token", 3), varied)


def candidates(docs: DataFrame, owner: str, repository: list[str]) -> DataFrame:
    """_row, doc_id, _owner, _repo, _base and _mixed spans of every document, stored without the text."""
    text = F.coalesce("text", F.lit(""))
    repo = F.to_json(F.struct(*repository), {"ignoreNullFields": "false"})
    rows = docs.select("doc_id", F.col(owner).alias("_owner"), repo.alias("_repo"), base_spans(text).alias("_base"), mixed_spans(text).alias("_mixed"))
    rows = rows.select("doc_id", "_owner", "_repo", "_base", spans.apart(F.col("_mixed"), F.col("_base")).alias("_mixed"))
    return stored(rows.withColumn("_row", F.monotonically_increasing_id()), "secret-candidates")


def ownership(found: DataFrame) -> DataFrame:
    """(value, owners, repositories, documents) of every candidate value."""
    each = found.select("_owner", "_repo", F.explode(F.array_distinct(F.transform(F.concat("_base", "_mixed"), lambda s: F.sha2(s["value"], 256)))).alias("value"))
    repos = each.groupBy("value", "_owner", "_repo").agg(F.count(F.lit(1)).alias("documents"))
    owners = repos.groupBy("value", "_owner").agg(F.count(F.lit(1)).alias("repositories"), F.sum("documents").alias("documents"))
    return owners.groupBy("value").agg(F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories"), F.sum("documents").alias("documents"))


def scan(
    docs: DataFrame,
    owner: str = "source",
    repository: list[str] | None = None,
    live_owners: int = LIVE_OWNERS,
    live_repositories: int = LIVE_REPOSITORIES,
    live_documents: int = LIVE_DOCUMENTS,
) -> DataFrame:
    """Per document: doc_id, base and all spans as arrays, n_live and n_examples of its candidate values.

    Of the examples, n_copied_owners are copied over owners, n_copied_inside within one owner.
    """
    found = candidates(docs, owner, repository or ["source", "lang"])
    over, inside = F.col("owners") > live_owners, (F.col("repositories") > live_repositories) | (F.col("documents") > live_documents)
    # a value of one document looks live: only copied ones need their verdict back
    shared = ownership(found).where(over | inside).select("value", over.alias("over"))
    one = F.explode(F.concat("_base", "_mixed")).alias("span")
    each = found.where(F.size("_base") + F.size("_mixed") > 0).select("_row", one).withColumn("value", F.sha2("span.value", 256))
    judged = lookup(each, shared, ["value"], "_row").withColumn("live", F.col("over").isNull())
    kept = F.when((F.col("span.kind") != "token") | F.col("live"), F.col("span"))
    per_row = judged.groupBy(F.col("_row").alias("_r")).agg(
        F.collect_list(kept).alias("_all"), F.count_if("live").alias("n_live"), F.count_if(~F.col("live")).alias("n_examples"),
        F.count_if("over").alias("n_copied_owners"), F.count_if(~F.col("over")).alias("n_copied_inside"),
    )
    joined = found.join(per_row, found["_row"] == per_row["_r"], "left")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_live", "n_examples", "n_copied_owners", "n_copied_inside")]
    return joined.select("doc_id", "_base", F.coalesce("_all", spans.none()).alias("_all"), *counts)

"""Enrichment: requests, replies read as JSON, names cleaned, quotes verified, costs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill.functions.folds import fold_quote
from pressmill.functions.text import collapse
from pressmill.operators.reports import long

KINDS = {"actores": "actor", "lugares": "lugar", "temas": "tema"}
QUOTES = "expectativas"
NAMES = (*KINDS, QUOTES)
LEAST_QUOTE = 30


def parsed(replies: DataFrame) -> DataFrame:
    """(id, usable, and for each list its strings): a reply that is no JSON object is unusable, items that are no strings
    are skipped, a missing list is empty."""
    doc = F.try_parse_json("reply")
    rows = replies.select("id", doc.alias("v"), "reply")
    rows = rows.withColumn("usable", F.coalesce(F.schema_of_variant("v").startswith("OBJECT"), F.lit(False)))
    lists = []
    for name in [*KINDS, QUOTES]:
        items = F.try_variant_get("v", f"$.{name}", "array<variant>")
        texts = F.transform(items, lambda x: F.when(F.schema_of_variant(x) == "STRING", F.try_variant_get(x, "$", "string")))
        lists.append(F.coalesce(F.filter(texts, lambda t: t.isNotNull()), F.array().cast("array<string>")).alias(name))
    return rows.select("id", "usable", *lists)


def placed_entities(parsed_replies: DataFrame) -> DataFrame:
    """(id, kind, name, at): white space collapsed, punctuation at the ends stripped, 2 to 80 characters, the first of forms
    that differ in case, with its place in the reply."""
    each = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(name).alias("names")) for name, kind in KINDS.items()])
    rows = parsed_replies.where("usable").select("id", F.explode(each).alias("k")).select("id", "k.kind", F.posexplode("k.names").alias("at", "name"))
    rows = rows.withColumn("name", F.regexp_replace(collapse(F.col("name")), r"^[ .,;:]+|[ .,;:]+\z", "")).where("length(name) between 2 and 80")
    return rows.groupBy("id", "kind", F.lower("name").alias("key")).agg(F.min_by("name", "at").alias("name"), F.min("at").alias("at")).select("id", "kind", "name", "at")


def entities(parsed_replies: DataFrame) -> DataFrame:
    return placed_entities(parsed_replies).drop("at")


def good_quotes(parsed_replies: DataFrame, arts: DataFrame) -> DataFrame:
    """(id, quotes): quotes of 30 characters or more that stand in the body, word for word after folding."""
    rows = parsed_replies.where("usable").select("id", QUOTES).join(arts.select("id", fold_quote(F.coalesce("body", F.lit(""))).alias("plain")), "id")
    good = F.filter(QUOTES, lambda q: (F.length(collapse(q)) >= LEAST_QUOTE) & F.contains("plain", fold_quote(q)))
    return rows.select("id", good.alias("quotes"), F.size(QUOTES).alias("said"))


def verified_quotes(parsed_replies: DataFrame, arts: DataFrame) -> DataFrame:
    """(id, kept, discarded) of the quotes of each reply."""
    return good_quotes(parsed_replies, arts).select("id", long(F.size("quotes")).alias("kept"), long(F.col("said") - F.size("quotes")).alias("discarded"))


def cost_estimate(arts: DataFrame, price_in: float = 1.0, price_out: float = 5.0) -> DataFrame:
    """Requests, tokens and cost of enriching full pieces; batches are half price."""
    rows = arts.where((F.col("kind") != "portada") & F.col("is_full"))
    totals = rows.agg(long(F.count("*")).alias("requests"), long(F.sum(F.length("body"))).alias("chars"))
    tokens_in, tokens_out = F.col("chars") / 3.6 + 400 * F.col("requests"), 300.0 * F.col("requests")
    cost = (tokens_in * price_in + tokens_out * price_out) / 1e6 / 2
    return totals.select("requests", "chars", F.round(tokens_in, 3).alias("tokens_in"), F.round(tokens_out, 3).alias("tokens_out"), F.round(cost, 6).alias("cost"))


def requests(arts: DataFrame, instruction: str, model: str, most_tokens: int = 2000) -> DataFrame:
    """(custom_id, request) with one JSON request for each piece: instruction, the schema that the reply has to follow, text."""
    content = F.concat(F.lit("TÍTULO: "), F.coalesce("title", F.lit("")), F.lit("\n\nTEXTO:\n"), F.coalesce("body", F.lit("")))
    lists = F.struct(*[F.struct(F.lit("array").alias("type"), F.struct(F.lit("string").alias("type")).alias("items")).alias(name) for name in NAMES])
    schema = F.struct(F.lit("object").alias("type"), lists.alias("properties"), F.array(*map(F.lit, NAMES)).alias("required"), F.lit(False).alias("additionalProperties"))
    wanted = F.struct(F.struct(F.lit("json_schema").alias("type"), schema.alias("schema")).alias("format"))
    told = F.array(F.struct(F.lit("user").alias("role"), content.alias("content")))
    body = F.to_json(F.struct(F.lit(model).alias("model"), F.lit(most_tokens).alias("max_tokens"), F.lit(instruction).alias("system"), wanted.alias("output_config"), told.alias("messages")))
    return arts.select(F.concat(F.lit("art-"), F.col("id").cast("string")).alias("custom_id"), body.alias("request"))


def ours(results: DataFrame) -> DataFrame:
    """Results (custom_id, status, reply) of our requests, with the id of the piece; a piece counts once."""
    rows = results.where(F.col("custom_id").startswith("art-")).withColumn("id", F.expr("try_cast(substring(custom_id, 5) as bigint)")).where("id is not null")
    return rows.groupBy("id").agg(F.min(F.struct(F.when(F.col("status") == "succeeded", 0).otherwise(1).alias("order"), "status", "reply")).alias("r")).select("id", "r.status", "r.reply")


def ingestion(results: DataFrame) -> DataFrame:
    """Totals of a batch of (custom_id, status, reply): stored, failed and unusable."""
    rows = ours(results)
    usable = parsed(rows.select("id", "reply")).select("id", "usable")
    ok = F.col("status") == "succeeded"
    return rows.join(usable, "id").agg(long(F.count_if(ok & F.col("usable"))).alias("ok"), long(F.count_if(~ok)).alias("error"), long(F.count_if(ok & ~F.col("usable"))).alias("unusable"))


def progress(arts: DataFrame) -> DataFrame:
    rows = arts.where((F.col("kind") != "portada") & F.col("is_full"))
    return rows.agg(long(F.count("*")).alias("total"), long(F.count_if("enriched")).alias("enriched"))


def enrichment_tags(parsed_replies: DataFrame, most: int = 10) -> DataFrame:
    """(id, tags): subjects and then places of a reply, as they are stored, in its order, the first ten."""
    rows = placed_entities(parsed_replies).where(F.col("kind").isin("tema", "lugar"))
    order = F.struct((F.col("kind") == "lugar").alias("place"), "at", "name")
    return rows.groupBy("id").agg(F.slice(F.transform(F.array_sort(F.collect_list(order)), lambda x: x["name"]), 1, most).alias("tags"))


def samples(enriched: DataFrame, found: DataFrame, quotes: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` pieces (id, enriched_at, title) enriched last, with their names by kind and up to two quotes."""
    last = enriched.orderBy(F.desc("enriched_at"), "id").limit(n)
    few = F.broadcast(last.select("id"))
    of = lambda kind: F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.col("name"))))
    names = found.join(few, "id").groupBy("id").agg(of("actor").alias("actors"), of("lugar").alias("places"), of("tema").alias("subjects"))
    said = quotes.join(few, "id").groupBy("id").agg(F.slice(F.array_sort(F.collect_list("quote")), 1, 2).alias("quotes"))
    return last.join(names, "id", "left").join(said, "id", "left")

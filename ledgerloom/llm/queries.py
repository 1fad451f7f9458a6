"""The queries of the numbered operators, each over the whole of its tables."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import language_id, toxicity
from .decontaminate import find_contamination
from .mixing import mix_plan
from .order_minhash import edit_report
from .periodic_runs import find_runs
from .pii import find_pii
from .quality_rules import quality_verdicts
from .resampling import resampling_plan
from .sampling import held_out
from .sharding import shard_plan
from .simhash import as_hex, simhash_components
from .site_quality import page_text, site_quality, with_site
from .tool_calls import link_tool_calls


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str | Column) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = find_contamination(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))
    items = F.array_join(F.array_sort(F.transform("found.items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id",
        F.col("found.n_words").alias("n_words"),
        F.col("found.n_hit").alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(items, 256).alias("items_sha256"),
        (F.col("found.n_hit") > 0).alias("contaminated"),
    )


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = shard_plan(table(spark, sf_dir, "documents", "doc_id", "text"))
    return plan.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mix_plan(table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return plan.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies"
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = quality_verdicts(table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"))
    return verdicts.drop("text_hash", "lang", "source")


#: Tools of ``op5_tool_calls``.
SCHEMAS = {
    "search": {
        "type": "object",
        "properties": {"query": {"type": "string"}, "limit": {"type": "integer"}},
        "required": ["query", "limit"],
        "additionalProperties": False,
    },
    "lookup": {
        "type": "object",
        "properties": {"key": {"type": "string"}, "strict": {"type": "boolean"}},
        "required": ["key"],
    },
    "summarise": {
        "type": "object",
        "properties": {"text": {"type": "string"}, "max_words": {"type": "integer"}},
        "required": ["text"],
    },
}


def op5_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table has no tool calls, so they are derived from it: every assistant turn is a call with its whole
    text, that uses the call two turns earlier; every other turn is the result of the turn before it. Some calls
    name a tool that isn't there, some have broken arguments, some use each other, and some share an identifier."""
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    number = F.coalesce("conv_id", F.lit(0)) * 7 + F.col("turn")

    def name_of(turn: Column) -> Column:
        return F.concat(F.lit("call-"), turn.cast("string"))

    kind = F.col("turn") % 3
    whole = (
        F.when(kind == 0, F.to_json(F.struct(F.col("text").alias("query"), F.col("turn").alias("limit"))))
        .when(kind == 1, F.to_json(F.struct(F.lit(True).alias("strict"), F.col("text").alias("key"))))
        .otherwise(F.to_json(F.struct(F.col("text"), F.length("text").alias("max_words"))))
    )
    # a call whose number is a multiple of 17 has the identifier of the one before it
    own = F.when(number % 17 == 0, F.col("turn") - 2).otherwise(F.col("turn"))
    calls = turns.where("role = 'assistant'").select(
        "conv_id",
        "turn",
        name_of(own).alias("call_id"),
        F.when(number % 13 == 0, "unlisted").when(kind == 0, "search").when(kind == 1, "lookup").otherwise("summarise").alias("name"),
        F.when(number % 11 == 0, F.concat(F.lit("{"), "text")).otherwise(whole).alias("arguments"),
        name_of(F.when(number % 19 == 0, F.col("turn") + 2).otherwise(F.col("turn") - 2)).alias("after"),
    )
    results = turns.where("role <> 'assistant'").select(
        "conv_id", "turn", name_of(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content")
    )
    linked = link_tool_calls(calls, results, SCHEMAS)
    return linked.withColumns({"problems": F.array_join("problems", "; "), "n_results": F.coalesce("n_results", F.lit(0))})


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    scored = toxicity.score_toxicity(docs, model)
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("toxicity.score").alias("score"),
        (F.col("toxicity.score") >= 0.5).cast("int").alias("predicted"),
        F.col("toxicity.spans").alias("spans"),
    )


BASE_KINDS = ("email", "ip", "card", "phone")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents", "doc_id", "text"))

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("pii", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select(
        "doc_id",
        *(F.size(F.filter("pii", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("pii")).alias("spans"),
        F.transform("pii", lambda s: s["score"]).alias("scores"),
    )


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    found = language_id.identify(docs.select("doc_id", "text"), language_id.train(docs))
    return found.select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"),
        F.col("language.family").alias("family"),
    )


def op9_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and pages as one table of texts. Documents have no address: their source stands for the host, the
    language for the path. Pages have one, and numbers below zero in the joint table, so that no label is theirs."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", F.col("source").alias("host"), F.col("lang").alias("path"))
    pages = with_site(table(spark, sf_dir, "pages", "page_id", "url", "html"), "url")
    pages = pages.select((-1 - F.col("page_id")).alias("doc_id"), page_text(F.col("html")).alias("text"), "host", "path")
    found = site_quality(docs.union(pages), table(spark, sf_dir, "labels", "doc_id", "quality"), host_column="host", path_column="path")
    is_page = F.col("doc_id") < 0
    return found.withColumns(
        {
            "kind": F.when(is_page, "page").otherwise("document"),
            "doc_id": F.when(~is_page, F.col("doc_id")),
            "page_id": F.when(is_page, -1 - F.col("doc_id")),
        }
    )


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    plan = resampling_plan(docs, table(spark, sf_dir, "benchmark", "text"))
    return plan.select("doc_id", "n_features", "weight", "score", "rank")


def planted(docs: DataFrame) -> DataFrame:
    """Every tenth text, by a hash of its id, with its last words replaced by repeats of some of them."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, a, p, g = (F.col(c) for c in ("n", "a", "p", "g"))
    chosen = docs.withColumn("words", F.when(h % 10 == 0, words)).withColumn("n", F.size("words")).withColumn("g", F.floor(h / 10))
    chosen = chosen.withColumn("a", F.when(n > 0, g % n).cast("int"))
    chosen = chosen.withColumn("p", (1 + F.floor((n - a) / (3 + g % 8))).cast("int"))
    times = F.ceil((n - a) / p).cast("int")
    repeats = F.slice(F.flatten(F.array_repeat(F.slice("words", a + 1, p), times)), F.lit(1), n - a)
    text = F.array_join(F.concat(F.slice("words", F.lit(1), a), repeats), " ")
    return chosen.select("doc_id", F.when(n > 0, text).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(planted(table(spark, sf_dir, "documents", "doc_id", "text")))
    runs = F.col("periodic.runs")
    longest = F.array_max(F.transform(runs, lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.select("doc_id", runs.alias("runs"), longest.alias("best"), lines.alias("lines"), "periodic.collapsed")
    length, start, period = F.col("best.length"), -F.col("best.col2"), -F.col("best.col3")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.cast("long").alias("start"),
        length.cast("long").alias("length"),
        period.cast("long").alias("period"),
        F.floor(F.lit(1000) * length / period).alias("exponent_milli"),
        F.sha2(F.array_join("lines", ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_report(table(spark, sf_dir, "documents", "doc_id", "text"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_sharding": op2_sharding,
    "op3_mixing": op3_mixing,
    "op4_quality_rules": op4_quality_rules,
    "op5_tool_calls": op5_tool_calls,
    "op6_toxicity": op6_toxicity,
    "op7_pii": op7_pii,
    "op8_language_id": op8_language_id,
    "op9_site_quality": op9_site_quality,
    "op10_simhash": op10_simhash,
    "op11_resampling": op11_resampling,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_fingerprints": op13_fingerprints,
}

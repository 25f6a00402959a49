"""JSON fields and rule classification."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import documents, query, table
from corpusloom.functions.rules import (
    chunk_content,
    classify_by_rules,
    is_large,
    json_fields,
    json_has_any,
    MANIFEST_PATHS,
    model_family,
    size_from_name,
    triage_messages,
)
from corpusloom.operators.classify import classify_listing, classify_names
from corpusloom.operators.needles import classify_by_table, classify_listing_by_table, mark_rules

# model manifests made of parts
ARCHITECTURES = {
    "MEDIUM": "LlamaForCausalLM",
    "STANDARD": "Qwen2MoeForCausalLM",
    "LARGE": "PhiForCausalLM",
    "PROMO": "GPT2LMHeadModel",
    "SMALL": "BitNetForCausalLM",
    "ECONOMY": "OtherModel",
}
_ARCH_CASE = "CASE p_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ARCHITECTURES.items()) + " END"
MANIFESTS_SQL = f"""manifests AS (
  SELECT p_partkey, arch, name, CASE WHEN p_size = 1 THEN 'not json' ELSE
    '{{"architectures": ["' || arch || '"], "model_type": "' || p_name || '"'
    || CASE WHEN p_size > 40 THEN ', "num_params": ' || p_size || '000000000' ELSE '' END
    || CASE WHEN p_size % 7 = 0 THEN ', "vision_config": {{"x": 1}}' ELSE '' END || '}}' END AS manifest
  FROM (SELECT *, {_ARCH_CASE} AS arch,
        replace(p_name, ' ', '-') || CASE p_size % 4 WHEN 0 THEN '-7b' WHEN 1 THEN '-14B' WHEN 2 THEN '-1.5b' ELSE '-72b' END
        || CASE WHEN p_partkey % 2 = 0 THEN '-Qwen' ELSE '' END AS name FROM part))"""


def _manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    arch = None
    for kind, value in ARCHITECTURES.items():
        hit = F.col("p_type") == kind
        arch = F.when(hit, value) if arch is None else arch.when(hit, value)
    tag = F.col("p_size") % 4
    name = F.concat(
        F.replace("p_name", F.lit(" "), F.lit("-")), F.when(tag == 0, "-7b").when(tag == 1, "-14B").when(tag == 2, "-1.5b").otherwise("-72b"),
        F.when(F.col("p_partkey") % 2 == 0, "-Qwen").otherwise(""),
    )
    manifest = F.concat(
        F.lit('{"architectures": ["'),
        "arch",
        F.lit('"], "model_type": "'),
        "p_name",
        F.lit('"'),
        F.when(F.col("p_size") > 40, F.concat(F.lit(', "num_params": '), "p_size", F.lit("000000000"))).otherwise(""),
        F.when(F.col("p_size") % 7 == 0, ', "vision_config": {"x": 1}').otherwise(""),
        F.lit("}"),
    )
    parts = table(spark, sf_dir, "part").withColumn("arch", arch)
    return parts.select(
        "p_partkey", "arch", name.alias("name"), F.when(F.col("p_size") == 1, "not json").otherwise(manifest).alias("manifest")
    )


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.gone') AS gone FROM events")
def j1_json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select("event_id", json_fields("props", {"k": "$.k", "gone": "$.gone"}).alias("f")).select("event_id", "f.*")


@query(
    f"""WITH {MANIFESTS_SQL}, valid AS (SELECT *, CASE WHEN json_valid(manifest) THEN manifest END AS j FROM manifests)
    SELECT p_partkey, json_extract_string(j, '$.architectures[0]') AS architecture,
           json_extract_string(j, '$.model_type') AS model_type, coalesce(json_extract_string(j, '$.num_params'), '0') AS num_params,
           coalesce(json_exists(j, '$.vision_config'), false) AS vision FROM valid"""
)
def j1_manifest_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _manifests(spark, sf_dir)
        .select("p_partkey", json_fields("manifest", MANIFEST_PATHS, {"num_params": "0"}).alias("f"), json_has_any("manifest").alias("vision"))
        .select("p_partkey", "f.*", "vision")
    )


@query(
    """SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_type END AS content FROM events"""
)
def j1_chunk_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    delta = F.when(F.col("event_id") % 4 == 0, F.lit("{}")).otherwise(F.concat(F.lit('{"content": "'), "event_type", F.lit('"}')))
    raw = F.concat(F.lit('{"choices": [{"delta": '), delta, F.lit("}]}"))
    return table(spark, sf_dir, "events").select("event_id", chunk_content(raw).alias("content"))


_FAMILY_SQL = """CASE WHEN contains(a, 'bitnet') THEN 'bitnet'
  WHEN contains(a, 'llama') OR contains(a, 'mistral') OR contains(a, 'mixtral') THEN 'llama'
  WHEN contains(a, 'moe') OR contains(a, 'qwen') OR contains(a, 'deepseek') OR contains(a, 'gpt-neox') THEN 'moe'
  WHEN contains(a, 'phi') THEN 'phi' WHEN contains(a, 'gpt') THEN 'gpt' ELSE 'hf' END"""


@query(f"WITH {MANIFESTS_SQL} SELECT p_partkey, {_FAMILY_SQL} AS family FROM (SELECT *, lower(arch) AS a FROM manifests)")
def j2_classify_by_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _manifests(spark, sf_dir).select("p_partkey", classify_by_rules("arch").alias("family"))


@query(
    f"""WITH {MANIFESTS_SQL} SELECT p_partkey, CASE WHEN contains(a, 'moe') OR contains(a, 'mixture') OR contains(a, 'qwen') THEN 'moe'
        WHEN contains(a, 'bitnet') THEN 'bitnet' WHEN contains(lower(name), 'bitnet') THEN 'bitnet' ELSE {_FAMILY_SQL} END AS family
        FROM (SELECT *, lower(arch) AS a FROM manifests)"""
)
def j2_model_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _manifests(spark, sf_dir).select("p_partkey", model_family("arch", "name").alias("family"))


_LISTING_RULES = ((("red ", "hot "), "warm"), (("blue ",), "cool"))


@query(
    """SELECT p_brand, p_size, CASE WHEN bool_or(p_partkey % 17 = 0) THEN 'gguf'
       WHEN bool_or(contains(lower(p_name), 'red ') OR contains(lower(p_name), 'hot ')) THEN 'warm'
       WHEN bool_or(contains(lower(p_name), 'blue ')) THEN 'cool' ELSE 'plain' END AS label FROM part GROUP BY p_brand, p_size"""
)
def j3_classify_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = F.when(F.col("p_partkey") % 17 == 0, F.concat("p_name", F.lit(".GGuf"))).otherwise(F.col("p_name"))
    names = table(spark, sf_dir, "part").select("p_brand", "p_size", packed.alias("name"))
    return classify_listing(names, ["p_brand", "p_size"], "name", _LISTING_RULES, "plain")


@query(
    """SELECT p_partkey, CASE WHEN p_type IN ('SMALL', 'LARGE') THEN 'gguf' ELSE 'hf' END AS label FROM part"""
)
def j3_classify_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = F.when(F.col("p_type") == "SMALL", "model-GGML.bin").when(F.col("p_type") == "LARGE", "m.Gguf").otherwise("pytorch_model.gguf.bin")
    return table(spark, sf_dir, "part").select("p_partkey", classify_names(F.array(F.col("p_name"), weights)).alias("label"))


@query(
    f"""WITH {MANIFESTS_SQL}, sized AS (
      SELECT p_partkey, coalesce(nullif(TRY_CAST(regexp_extract(manifest, '"num_params": (\\d+)', 1) AS DOUBLE), 0),
        CASE WHEN NOT contains(lower(name), 'qwen') THEN 0 WHEN contains(lower(name), '-1.5b') THEN 1.5e9 WHEN contains(lower(name), '-7b') THEN 7e9
             WHEN contains(lower(name), '-14b') THEN 14e9 WHEN contains(lower(name), '-72b') THEN 72e9 ELSE 0 END) AS num_params FROM manifests)
    SELECT p_partkey, CAST(num_params AS BIGINT) AS num_params, num_params > 10e9 AS is_large FROM sized"""
)
def j4_size_from_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    stated = json_fields("manifest", MANIFEST_PATHS)["num_params"]
    sized = _manifests(spark, sf_dir).select("p_partkey", size_from_name("name", stated).alias("num_params"))
    return sized.select("p_partkey", F.col("num_params").cast("long").alias("num_params"), is_large("num_params").alias("is_large"))


_TRIAGE_RULES = (
    ("purchase failed", "billing", "ask for another payment"),
    ("error", "fault", "read the log"),
    ("click", "usage", "nothing to do"),
)


@query(
    """SELECT event_id, CASE WHEN contains(m, 'purchase failed') THEN 'billing' WHEN contains(m, 'error') THEN 'fault'
         WHEN contains(m, 'click') THEN 'usage' ELSE 'other' END AS category, m AS detail,
       CASE WHEN contains(m, 'purchase failed') THEN 'ask for another payment' WHEN contains(m, 'error') THEN 'read the log'
         WHEN contains(m, 'click') THEN 'nothing to do' ELSE 'look closer' END AS suggestion
       FROM (SELECT event_id, event_type || ' failed with ' || props AS m FROM events)"""
)
def j5_triage_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id", F.concat("event_type", F.lit(" failed with "), "props").alias("m")
    )
    return events.select("event_id", triage_messages("m", _TRIAGE_RULES, ("other", "look closer")).alias("t")).select("event_id", "t.*")


# rules from tables: every long word of a benchmark item leads to the item; every kind of part leads to its type
WORD_RULES_SQL = """word_rules AS (
  SELECT unnest(regexp_extract_all(text, '[^ \\n]{6,}')) AS needle, length(text) % 50 AS priority, item_id AS label FROM benchmark)"""
PART_RULES_SQL = """part_rules AS (
  SELECT p_brand || ' ' || p_name || ' ' || p_size AS needle, p_partkey % 100 AS priority, p_type AS label FROM part)"""


def _word_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.regexp_extract_all("text", F.lit("[^ \\n]{6,}"), F.lit(0))
    items = table(spark, sf_dir, "benchmark")
    return items.select(F.explode(words).alias("needle"), (F.char_length("text") % 50).alias("priority"), F.col("item_id").alias("label"))


def _part_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    return parts.select(F.concat_ws(" ", "p_brand", "p_name", "p_size").alias("needle"), (F.col("p_partkey") % 100).alias("priority"), F.col("p_type").alias("label"))


_WORDS_IN_DOCS_SQL = f"""WITH {WORD_RULES_SQL}, used AS (
      SELECT needle, min({{'priority': priority, 'label': CAST(label AS VARCHAR)}}) AS best FROM word_rules GROUP BY needle),
    hits AS (SELECT doc_id, min(best) AS best FROM documents JOIN used ON contains(text, needle) GROUP BY doc_id)
    SELECT doc_id, best.priority AS priority, coalesce(best.label, 'none') AS label FROM documents LEFT JOIN hits USING (doc_id)"""


@query(_WORDS_IN_DOCS_SQL)
def j2_rules_from_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = mark_rules(documents(spark, sf_dir), "text", _word_rules(spark, sf_dir), ignore_case=False)
    return marked.select("doc_id", F.col("rule.priority").alias("priority"), F.coalesce("rule.label", F.lit("none")).alias("label"))


@query(_WORDS_IN_DOCS_SQL)
def j2_rules_from_table_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = mark_rules(documents(spark, sf_dir), "text", _word_rules(spark, sf_dir), ignore_case=False, max_needles=0)
    return marked.select("doc_id", F.col("rule.priority").alias("priority"), F.coalesce("rule.label", F.lit("none")).alias("label"))


@query(
    f"""WITH {PART_RULES_SQL}, names AS (SELECT p_retailprice % 10 AS shelf, 'in ' || lower(p_brand) || ' ' || upper(p_name) || ' ' || p_size || '0' AS name FROM part),
    hits AS (SELECT shelf, min({{'priority': priority, 'label': label}}) AS best FROM names JOIN part_rules ON contains(lower(name), lower(needle)) GROUP BY shelf)
    SELECT shelf, coalesce(best.label, 'none') AS label FROM (SELECT DISTINCT shelf FROM names) LEFT JOIN hits USING (shelf)"""
)
def j3_listing_from_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.lit("in "), F.lower("p_brand"), F.lit(" "), F.upper("p_name"), F.lit(" "), "p_size", F.lit("0"))
    names = table(spark, sf_dir, "part").select((F.col("p_retailprice") % 10).alias("shelf"), name.alias("name"))
    return classify_listing_by_table(names, ["shelf"], "name", _part_rules(spark, sf_dir), "none")


@query(
    f"""WITH {PART_RULES_SQL}, messages AS (SELECT p_partkey, 'part ' || p_brand || ' ' || p_name || ' ' || p_size || p_partkey % 7 || ' is out' AS m FROM part),
    hits AS (SELECT p_partkey, min({{'priority': priority, 'label': label}}) AS best FROM messages JOIN part_rules ON contains(m, needle) GROUP BY p_partkey)
    SELECT p_partkey, coalesce(best.label, 'other') AS category, m AS detail FROM messages LEFT JOIN hits USING (p_partkey)"""
)
def j5_triage_from_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.concat_ws(" ", "p_brand", "p_name", F.concat(F.col("p_size").cast("string"), (F.col("p_partkey") % 7).cast("string")))
    messages = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("part "), kind, F.lit(" is out")).alias("detail"))
    return classify_by_table(messages, "detail", _part_rules(spark, sf_dir), "other", "category", ignore_case=False)

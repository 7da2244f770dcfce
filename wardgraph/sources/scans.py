"""Scans of landed files; every schema is fixed."""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardgraph.functions.ids import year_of_id

LIST = "array<string>"
VULN_PAGE = "vulnerabilities array<struct<cve:struct<id:string,descriptions:array<struct<lang:string,value:string>>,published:timestamp>>>"
VULN_MAP = f"map<string,struct<CWE:{LIST},CAPEC:{LIST},TECHNIQUES:{LIST},DEFEND:{LIST},OWASP:{LIST}>>"
DEFEND_MAP = "map<string,array<struct<id:string>>>"
WEAKNESS_XML = "_ID string, _Name string, Description string, Related_Weaknesses struct<Related_Weakness:array<struct<_CWE_ID:string,_Nature:string>>>, ChildOf array<struct<Weakness:array<struct<_CWE_ID:string>>>>, Related_Attack_Patterns struct<Related_Attack_Pattern:array<struct<_CAPEC_ID:string>>>"
ERROR_LINE = "timestamp string, level string, message string, error_record struct<timestamp:string,error_id:string,category:string,severity:string,message:string,retry_count:int,resolved:boolean>, exception string"
# fixed values: positions of id, name, description in the sheets of each framework
SHEETS = {"enterprise": (9, 1, 2), "mobile": (10, 1, 2), "ics": (9, 1, 2)}


def vuln_pages(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """One row per record of landed API pages, a page a file or, as `lines`, a page a line; empty pages give none."""
    return spark.read.schema(VULN_PAGE).json(path, multiLine=not lines).select(F.explode("vulnerabilities").alias("v")).select("v.cve.*")


def vuln_pages_stream(spark: SparkSession, path: str, files: int = 1, lines: bool = False) -> DataFrame:
    return spark.readStream.schema(VULN_PAGE).option("multiLine", not lines).option("maxFilesPerTrigger", files).json(path).select(F.explode("vulnerabilities").alias("v")).select("v.cve.*")


def year_partition(spark: SparkSession, path: str, wanted: DataFrame, year: str = "year") -> tuple[DataFrame, DataFrame]:
    """Rows of a table partitioned by year, of the years that a list of wanted ids (cve_id) names: other years are not read.
    And those years that the table lacks, which are logged."""
    table = spark.read.parquet(path)
    years = wanted.select(year_of_id(F.col("cve_id")).alias(year)).where(F.col(year).isNotNull()).distinct()
    missing = years.join(table.select(year).distinct(), year, "left_anti")
    for r in missing.collect():  # as many as years are wanted
        logging.getLogger(__name__).warning("no records of year %s", r[0])
    return table.join(F.broadcast(years), year, "left_semi"), missing  # a row a year


def table_status(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """name, exists, entries, modified (of its newest file) of each table."""
    parts = []
    for name, path in paths.items():
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        if at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
            rows = spark.read.parquet(path).select(F.col("_metadata.file_modification_time").alias("m"))
            parts.append(rows.agg(F.lit(name).alias("name"), F.lit(True).alias("exists"), F.count("*").alias("entries"), F.max("m").alias("modified")))
        else:
            parts.append(spark.range(1).select(F.lit(name).alias("name"), F.lit(False).alias("exists"), F.lit(0).cast("long").alias("entries"), F.lit(None).cast("timestamp").alias("modified")))
    return reduce(DataFrame.unionByName, parts)


def page_range(rows: DataFrame, order: list[str], start: int, size: int) -> DataFrame:
    """Rows start .. start + size - 1 in order; fewer at the end."""
    return rows.orderBy(*order).offset(start).limit(size)


def attack_pattern_csv(spark: SparkSession, path: str) -> DataFrame:
    """Patterns of a CSV whose first column is named 'ID; blank ids are left out, of repeated ids the last stays."""
    raw = spark.read.schema("`'ID` string, Name string, `Taxonomy Mappings` string").csv(path, header=True, multiLine=True, escape='"', enforceSchema=False)
    rows = raw.select(F.trim(F.col("`'ID`")).alias("capec_id"), F.col("Name").alias("name"), F.col("Taxonomy Mappings").alias("taxonomy"), F.col("_metadata.file_path").alias("f"), F.monotonically_increasing_id().alias("n"))
    rows = rows.where("coalesce(capec_id, '') <> ''")  # a file of many lines is one partition here, so n is its order
    return rows.groupBy("capec_id").agg(F.max_by(F.struct("name", "taxonomy"), F.struct("f", "n")).alias("r")).select("capec_id", "r.name", "r.taxonomy")


def weakness_xml(spark: SparkSession, path: str) -> DataFrame:
    """Weakness elements: id, name, description, parents and related patterns."""
    raw = spark.read.format("xml").option("rowTag", "Weakness").schema(WEAKNESS_XML).load(path)
    related = F.transform(F.filter("Related_Weaknesses.Related_Weakness", lambda r: r["_Nature"] == "ChildOf"), lambda r: r["_CWE_ID"])
    nested = F.flatten(F.transform("ChildOf", lambda c: F.transform(c["Weakness"], lambda w: w["_CWE_ID"])))
    none = F.array().cast(LIST)
    patterns = F.transform("Related_Attack_Patterns.Related_Attack_Pattern", lambda p: p["_CAPEC_ID"])
    return raw.where("coalesce(_ID, '') <> ''").select(F.col("_ID").alias("cwe_id"), F.col("_Name").alias("name"), F.col("Description").alias("description"), F.concat(F.coalesce(nested, none), F.coalesce(related, none)).alias("child_of"), F.coalesce(patterns, none).alias("related_attack_patterns"))


def technique_sheets(spark: SparkSession, paths: dict[str, str], columns: int = 11) -> DataFrame:
    """CSV exports of the frameworks' sheets, by position; of an id in several the later framework stays."""
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(columns)])
    parts = []
    for n, (framework, path) in enumerate(paths.items()):
        at, name, text = SHEETS[framework]
        raw = spark.read.schema(schema).csv(path, header=True, multiLine=True, escape='"')
        parts.append(raw.select(F.trim(f"c{at}").alias("technique_id"), F.lit(framework).alias("framework"), F.col(f"c{name}").alias("name"), F.col(f"c{text}").alias("description"), F.lit(n).alias("n")))
    rows = reduce(DataFrame.unionByName, parts).where("coalesce(technique_id, '') <> '' and lower(technique_id) <> 'nan'")
    return rows.groupBy("technique_id").agg(F.max_by(F.struct("framework", "name", "description"), "n").alias("r")).select("technique_id", "r.*")


#: Repeated ids up to which they are broadcast.
FEW_IDS = 500_000


def jsonl_map(lines: DataFrame, value: str = "value", seq: str = "seq", mode: str = "FAILFAST", few: int = FEW_IDS) -> DataFrame:
    """Lines {cve_id: {...}} -> one row per id; of a repeated id the last line's stays. FAILFAST: a bad line is an
    error; PERMISSIVE: bad and blank lines are skipped. Lines are read twice, so they should be files: first for the ids alone,
    which tell the repeated ones; then only records of these are shuffled, the others stay where they are. More than `few`
    repeated ids are not told apart: all records are shuffled."""
    parsed = lines.where(F.trim(value) != "").select(F.from_json(value, VULN_MAP, {"mode": mode}).alias("m"), F.col(seq).alias("seq"))
    ids = parsed.select(F.explode(F.map_keys("m")).alias("cve_id")).groupBy("cve_id").agg(F.count("*").alias("n"))
    repeated = ids.where("n > 1").select("cve_id").limit(few + 1).collect()
    rows = parsed.select(F.explode("m").alias("cve_id", "r"), "seq")
    if len(repeated) <= few:
        known = F.broadcast(lines.sparkSession.createDataFrame(repeated, "cve_id string"))
        once, rows = rows.join(known, "cve_id", "left_anti").select("cve_id", "r"), rows.join(known, "cve_id", "left_semi")
    none = F.array().cast(LIST)
    last = rows.groupBy("cve_id").agg(F.max_by("r", "seq").alias("r"))
    if len(repeated) <= few:
        last = once.union(last) if repeated else once
    return last.select("cve_id", *(F.coalesce(f"r.{c}", none).alias(n) for c, n in (("CWE", "cwe"), ("CAPEC", "capec"), ("TECHNIQUES", "techniques"), ("DEFEND", "defend"), ("OWASP", "owasp"))))


def jsonl_split(lines: DataFrame, value: str = "value") -> DataFrame:
    """Lines with status good or bad; blank ones are left out."""
    return lines.where(F.trim(value) != "").withColumn("status", F.when(F.from_json(value, VULN_MAP).isNotNull(), "good").otherwise("bad"))


def countermeasures(lines: DataFrame, value: str = "value", seq: str = "seq") -> DataFrame:
    """Lines {T: [{id}]} -> (technique_id, d3f_id); a later line replaces the whole list of its key."""
    rows = lines.select(F.explode(F.from_json(value, DEFEND_MAP)).alias("technique_id", "ids"), F.col(seq).alias("seq"))
    last = rows.groupBy("technique_id").agg(F.max_by("ids", "seq").alias("ids"))
    return last.select("technique_id", F.explode("ids.id").alias("d3f_id"))


def object_table(spark: SparkSession, path: str, value_schema: str, key: str = "id", lines: bool = False) -> DataFrame:
    """JSON objects by id, each a whole file or, as `lines`, a line -> rows."""
    raw = spark.read.text(path, wholetext=not lines)
    return raw.select(F.explode(F.from_json("value", f"map<string,{value_schema}>")).alias(key, "r")).select(key, "r.*")


def category_map(spark: SparkSession, path: str, lines: bool = False) -> tuple[DataFrame, DataFrame]:
    """Documents, each a whole file or, as `lines`, a line -> categories and the (cwe_id, category_id) mapping, which keeps repeats; without a mapping it is made of the
    categories' own lists."""
    schema = "categories map<string,struct<name:string,description:string,cwe_ids:array<string>>>, cwe_mapping map<string,array<string>>"
    raw = spark.read.text(path, wholetext=not lines).select(F.from_json("value", schema).alias("j"))
    cats = raw.select(F.explode("j.categories").alias("category_id", "c"))
    given = raw.select(F.explode("j.cwe_mapping").alias("cwe_id", "cats")).select("cwe_id", F.explode("cats").alias("category_id"))
    made = raw.where("j.cwe_mapping is null").select(F.explode("j.categories").alias("category_id", "c")).select(F.explode("c.cwe_ids").alias("cwe_id"), "category_id")
    return cats.select("category_id", "c.name", "c.description"), given.unionByName(made)


def first_available(parts: list[DataFrame], key: str) -> DataFrame:
    """For each key the row of the first source that has it."""
    rows = reduce(DataFrame.unionByName, (p.withColumn("priority", F.lit(i)) for i, p in enumerate(parts)))
    rest = [c for c in rows.columns if c not in (key, "priority")]
    return rows.groupBy(key).agg(F.min_by(F.struct(*rest), "priority").alias("r")).select(key, "r.*")


def layer_json(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Layers of files or, as `lines`, of lines that hold one or a list."""
    return layers_of(spark.read.text(path, wholetext=not lines))


def layers_of(texts: DataFrame) -> DataFrame:
    """(value) -> the layers of each text, which holds one or a list, any version: fields of a wrong type take their defaults,
    old names become those of version 4.5, stages are dropped. One row a layer, with its cells as an array."""
    raw = texts.select(F.try_parse_json("value").alias("v"))
    one = raw.select(F.when(F.schema_of_variant("v").startswith("ARRAY"), F.try_variant_get("v", "$", "array<variant>")).otherwise(F.array("v")).alias("vs")).select(F.explode("vs").alias("v"))
    get = lambda path, kind: F.try_variant_get("v", path, kind)
    # a text that could be read as a truth value is of a wrong type all the same
    flag = lambda v, path: F.when(F.schema_of_variant(F.try_variant_get(v, path, "variant")) == "BOOLEAN", F.try_variant_get(v, path, "boolean"))
    full = get("$.viewFullTable", "boolean")
    view = F.coalesce(get("$.viewMode", "int"), F.when(full, 0).when(~full, 1))
    layout = F.coalesce(get("$.layout.layout", "string"), F.when(view == 1, "side").when(view == 2, "mini"), F.lit("side"))
    cells = F.transform(
        get("$.techniques", "array<variant>"),
        lambda t: F.struct(
            F.try_variant_get(t, "$.techniqueID", "string").alias("technique_id"),
            F.try_variant_get(t, "$.tactic", "string").alias("tactic"),
            F.try_variant_get(t, "$.score", "double").alias("score"),
            F.coalesce(F.try_variant_get(t, "$.color", "string"), F.lit("")).alias("color"),
            F.coalesce(F.try_variant_get(t, "$.comment", "string"), F.lit("")).alias("comment"),
            F.coalesce(flag(t, "$.enabled"), F.lit(True)).alias("enabled"),
            F.coalesce(flag(t, "$.showSubtechniques"), F.lit(False)).alias("show_subtechniques"),
        ),
    )
    return one.select(
        get("$.name", "string").alias("name"),
        F.coalesce(get("$.versions.layer", "string"), get("$.version", "string")).alias("layer_version"),
        F.regexp_replace(get("$.domain", "string"), "^mitre-(.*)$", "$1-attack").alias("domain"),
        F.coalesce(get("$.description", "string"), F.lit("")).alias("description"),
        get("$.filters.platforms", "array<string>").alias("platforms"),
        F.coalesce(get("$.sorting", "int"), F.lit(0)).alias("sorting"),
        layout.alias("layout"),
        F.coalesce(flag("v", "$.hideDisabled"), F.lit(False)).alias("hide_disabled"),
        F.coalesce(cells, F.array()).alias("techniques"),
    )


def error_log(lines: DataFrame) -> DataFrame:
    """JSON log lines that hold an error record."""
    return lines.select(F.from_json("value", ERROR_LINE).alias("j")).where("j.error_record is not null").select("j.error_record.*", "j.exception")


def countermeasure_tree(spark: SparkSession, path: str, depth: int | None = None, lines: bool = False) -> DataFrame:
    """Countermeasure matrices, each a whole file or, as `lines`, a line -> (column, parent, node, is_leaf, d3f_id). A node
    with children is a group even if it has an id; one with neither is dropped. Nodes are named by label, else name, else
    the end of @id. depth: levels that the tree is known to have at most; else a job for each finds the last."""
    raw = spark.read.text(path, wholetext=not lines).select(F.try_parse_json("value").alias("v"))
    arr = lambda c, p: F.try_variant_get(c, p, "array<variant>")
    txt = lambda c, p: F.try_variant_get(c, p, "string")
    label = lambda c: F.coalesce(txt(c, "$['rdfs:label']"), txt(c, "$.name"), F.element_at(F.split(txt(c, "$['@id']"), ":"), -1))
    level = raw.select(F.explode(F.coalesce(arr(F.col("v"), "$"), arr(F.col("v"), "$.tactics"), arr(F.col("v"), "$.columns"))).alias("v")).select(label(F.col("v")).alias("column"), label(F.col("v")).alias("parent"), F.explode(arr(F.col("v"), "$.children")).alias("v"))
    parts: list[DataFrame] = []
    while len(parts) < depth if depth else not parts or not level.isEmpty():
        kids = F.coalesce(F.size(arr(F.col("v"), "$.children")), F.lit(0))
        parts.append(level.select("column", "parent", label(F.col("v")).alias("node"), (kids <= 0).alias("is_leaf"), F.when(kids <= 0, txt(F.col("v"), "$['d3f:d3fend-id']")).alias("d3f_id")))
        level = level.select("column", label(F.col("v")).alias("parent"), F.explode(arr(F.col("v"), "$.children")).alias("v"))
    return reduce(DataFrame.unionByName, parts).where("not is_leaf or d3f_id is not null")

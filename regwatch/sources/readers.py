"""Readers of landed files (S1-S6, S11, A1). Schemas are given, never inferred; absent and empty values are null."""

from __future__ import annotations

import datetime as dt
import gzip
import io
import zipfile
from collections.abc import Iterator
from itertools import islice
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

DETAIL = """FHRSID string, LocalAuthorityBusinessID string, BusinessName string, BusinessType string, BusinessTypeID string, AddressLine1 string, AddressLine2 string, AddressLine3 string, AddressLine4 string,
PostCode string, RatingValue string, RatingKey string, RatingDate string, SchemeType string, NewRatingPending string, Scores struct<Hygiene: string, Structural: string, ConfidenceInManagement: string>,
Geocode struct<Longitude: string, Latitude: string>, _corrupt_record string"""
HEADER = "ExtractDate string, ItemCount string, ReturnCode string"
PUBLISHER = "LocalAuthorityId string, LocalAuthorityIdCode string, Name string, FriendlyName string, RegionName string, FileName string, EstablishmentCount string, Url string, Email string"
COMPANY = "company_name string, company_number string, company_status string, company_subtype string, company_type string, date_of_creation string, date_of_cessation string, registered_office_address struct<address_line_1: string, address_line_2: string, locality: string, region: string, postal_code: string, country: string>, sic_codes array<string>"
LOOKUP = "establishments array<struct<FHRSID: string, PostCode: string, BusinessName: string>>, meta struct<totalCount: long, totalPages: long, pageNumber: long>"


def _xml(spark: SparkSession, path: str, row: str, schema: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", row).option("nullValue", "").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").schema(schema).load(path)


def _text(name: str):
    return F.nullif(F.trim(F.col(name)), F.lit(""))


def read_register_xml(spark: SparkSession, path: str) -> DataFrame:
    """Entity rows of a publisher's file, with the numeric part of the rating apart."""
    rows = _xml(spark, path, "EstablishmentDetail", DETAIL)
    number = lambda name, kind: _text(name).try_cast(kind)
    lines = [_text(f"AddressLine{k}").alias(f"address_line_{k}") for k in range(1, 5)]
    # Spark refuses to read the broken records alone, so a part of no length of another column stands beside them.
    broken = F.concat("_corrupt_record", F.substring(F.coalesce("FHRSID", F.lit("")), 1, 0)).alias("_corrupt_record")
    return rows.select(
        number("FHRSID", "long").alias("entity_id"), _text("LocalAuthorityBusinessID").alias("local_business_id"), _text("BusinessName").alias("business_name"), _text("BusinessType").alias("business_type"),
        number("BusinessTypeID", "long").alias("business_type_id"), *lines, _text("PostCode").alias("post_code"), _text("RatingValue").alias("rating_value"), number("RatingValue", "long").alias("rating_value_numeric"),
        _text("RatingKey").alias("rating_key"), number("RatingDate", "date").alias("rating_date"), _text("SchemeType").alias("scheme_type"), (F.lower(_text("NewRatingPending")) == "true").alias("new_rating_pending"),
        number("Scores.Hygiene", "long").alias("hygiene_score"), number("Scores.Structural", "long").alias("structural_score"), number("Scores.ConfidenceInManagement", "long").alias("confidence_in_management_score"),
        number("Geocode.Longitude", "double").alias("longitude"), number("Geocode.Latitude", "double").alias("latitude"), broken, F.col("_metadata.file_path").alias("file"),
    )


def read_register_header(spark: SparkSession, path: str) -> DataFrame:
    """extract_date, item_count and return_code of each file."""
    rows = _xml(spark, path, "Header", HEADER)
    return rows.select(_text("ExtractDate").try_cast("date").alias("extract_date"), _text("ItemCount").try_cast("long").alias("item_count"), _text("ReturnCode").alias("return_code"), F.col("_metadata.file_path").alias("file"))


def split_bad_records(rows: DataFrame, key: str = "entity_id", file: str = "file") -> tuple[DataFrame, DataFrame]:
    """Rows with a key, once for each file, and the rows skipped for each file: without a key or repeated (S3). A file with
    a broken record (``_corrupt_record``) failed as a whole: it is a run of status parse_error and none of its rows count."""
    repeated = F.row_number().over(Window.partitionBy(file, key).orderBy(F.hash(*[c for c in rows.columns if c != file])))
    broken = F.col("_corrupt_record").isNotNull() if "_corrupt_record" in rows.columns else F.lit(False)
    marked = rows.withColumn("__nth", repeated).withColumn("__broken", broken)
    sound = ~F.col("__broken")
    skipped = marked.groupBy(file).agg(
        F.count_if(sound & F.col(key).isNull()).alias("no_key"), F.count_if(sound & F.col(key).isNotNull() & (F.col("__nth") > 1)).alias("repeated"), F.count_if("__broken").alias("broken")
    )
    status = F.when(F.col("broken") > 0, "parse_error").when(F.col("no_key") + F.col("repeated") > 0, "skipped").otherwise("ok")
    skipped = skipped.withColumn("status", status)
    good = marked.where(F.col(key).isNotNull() & (F.col("__nth") == 1)).drop("__nth", "__broken")
    return good.join(skipped.where("broken > 0").select(file), file, "left_anti").select(*rows.columns), skipped


def read_publisher_index(spark: SparkSession, path: str) -> DataFrame:
    """Publishers with a real id and a file."""
    rows = _xml(spark, path, "WebLocalAuthorityAPI", PUBLISHER)
    out = rows.select(_text("LocalAuthorityId").try_cast("long").alias("id"), _text("LocalAuthorityIdCode").alias("publisher"), _text("Name").alias("name"), _text("RegionName").alias("region_name"), _text("FileName").alias("file_url"), _text("EstablishmentCount").try_cast("long").alias("entity_count"))
    return out.where("id > 0 and file_url is not null")


def read_company_pages(spark: SparkSession, path: str, source: str) -> tuple[DataFrame, DataFrame]:
    """Companies of search pages, addresses flattened and codes sorted; and the hits and skipped items of the pages."""
    pages = spark.read.option("multiLine", True).schema(_page_schema()).json(path)
    items = pages.select(F.explode("items").alias("i")).select("i.*")
    good = items.where("company_number is not null").select(
        "company_number", "company_name", "company_status", "company_type", F.col("date_of_creation").try_cast("date").alias("date_of_creation"), "registered_office_address.*",
        F.array_sort("sic_codes").alias("sic_codes"), F.lit(source).alias("source"),
    )
    stats = pages.agg(F.max("hits").alias("hits"), F.sum(F.size(F.filter("items", lambda i: i["company_number"].isNull()))).alias("skipped"))
    return good, stats


def _page_schema():
    from pyspark.sql.types import ArrayType, LongType, StructField, StructType

    return StructType([StructField("hits", LongType()), StructField("items", ArrayType(StructType.fromDDL(COMPANY)))])


def read_lookup_pages(spark: SparkSession, path: str) -> DataFrame:
    """entity_id to post_code; empty is null, rows without an id go, later pages win."""
    pages = spark.read.option("multiLine", True).schema(LOOKUP).json(path)
    rows = pages.select(F.col("meta.pageNumber").alias("page"), F.posexplode("establishments").alias("pos", "e")).select("page", "pos", F.col("e.FHRSID").try_cast("long").alias("entity_id"), F.nullif(F.trim("e.PostCode"), F.lit("")).alias("post_code"))
    return rows.where("entity_id is not null").groupBy("entity_id").agg(F.max_by("post_code", F.struct("page", "pos")).alias("post_code"))


def read_ground_truth(spark: SparkSession, path: str) -> DataFrame:
    """Labels by hand; blank ones stay, flagged."""
    rows = spark.read.option("header", True).schema("entity_id string, true_company string, note string").csv(path)
    company = F.coalesce(F.trim("true_company"), F.lit(""))
    return rows.select(F.trim("entity_id").try_cast("long").alias("entity_id"), company.alias("true_company"), F.coalesce(F.trim("note"), F.lit("")).alias("note"), (company == "").alias("blank"))


RESULT = "array<struct<domain: string, result: string>>"
AUTH = f"file string, source_ip string, count long, disposition string, dkim string, spf string, header_from string, reporter string, begin date, end date, domain string, policy string, auth_spf {RESULT}, auth_dkim {RESULT}, error string"
#: Rows of a batch that a task hands on.
ROWS = 4096


def _opened(name: str, raw: bytes) -> io.BufferedIOBase:
    """What a report file holds, as a stream: the first member of a zip archive, an unpacked gzip, or the bytes themselves."""
    if name.lower().endswith(".zip"):
        archive = zipfile.ZipFile(io.BytesIO(raw))
        return archive.open(archive.namelist()[0])
    return gzip.GzipFile(fileobj=io.BytesIO(raw)) if name.lower().endswith(".gz") else io.BytesIO(raw)


def _said(node, path: str, default: str | None = None) -> str | None:
    return (node.findtext(path) or "").strip() or default


def _parts(source: io.BufferedIOBase) -> Iterator[tuple[str, dict]]:
    """What an XML document says, as it is read: each record of a report, and after them the report itself. What was read
    is dropped, so a document takes no more memory than one record and the heads of a report."""
    day = lambda x: dt.datetime.fromtimestamp(int(x), dt.timezone.utc).date() if x else None
    above: list = []
    for kind, node in ElementTree.iterparse(source, ("start", "end")):
        if kind == "start":
            above.append(node)
            continue
        above.pop()
        base = 0 if (above or [node])[0].tag == "feedback" else 1
        if node.tag == "record" and len(above) == base + 1 and above[base].tag == "feedback":
            checks = {f"auth_{k}": [{"domain": _said(x, "domain"), "result": _said(x, "result")} for x in node.findall(f"auth_results/{k}")] for k in ("spf", "dkim")}
            judged = {k: _said(node, f"row/policy_evaluated/{k}") for k in ("disposition", "dkim", "spf")}
            yield "record", judged | checks | {"source_ip": _said(node, "row/source_ip", "?"), "count": int(_said(node, "row/count", "0")), "header_from": _said(node, "identifiers/header_from")}
            above[-1].remove(node)
        elif len(above) == base:
            if node.tag == "feedback":
                span = "report_metadata/date_range"
                yield "report", {"reporter": _said(node, "report_metadata/org_name", "?"), "begin": day(_said(node, f"{span}/begin")), "end": day(_said(node, f"{span}/end")), "domain": _said(node, "policy_published/domain", "?"), "policy": _said(node, "policy_published/p", "-")}
            if above:
                above[-1].remove(node)


def _records(file: str, raw: bytes) -> Iterator[dict]:
    """The records of all reports in a file. It is read twice: first to see that all of it can be read, and what its reports
    say of all their records, wherever that stands; then to tell the records one by one."""
    reports = [said for kind, said in _parts(_opened(file, raw)) if kind == "report"]
    return _told(file, raw, reports)


def _told(file: str, raw: bytes, reports: list[dict]) -> Iterator[dict]:
    n = 0
    for kind, said in _parts(_opened(file, raw)):
        if kind == "record":
            yield {"file": file} | reports[n] | said
        else:
            n += 1


def _empty(spark: SparkSession, path: str) -> list[str]:
    """Names of the files of no bytes, which Spark's readers pass over."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().getName() for d in store.globStatus(at) or [] for f in store.listStatus(d.getPath()) if f.isFile() and f.getLen() == 0 and not f.getPath().getName().startswith(("_", "."))]


def read_auth_reports(spark: SparkSession, path: str) -> DataFrame:
    """A row for each record of mail-authentication reports, plain, gzip or zip, with the results of the senders' checks
    nested (A1). A file that cannot be read gives one row that holds its name and the error alone, and none of its records;
    ``auth_failures`` and ``auth_records`` tell them apart. A task holds the bytes of its files and ROWS records at a time."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    schema = to_arrow_schema(StructType.fromDDL(AUTH))

    def parse(batches: Iterator) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                name = batch.column("path")[k].as_py().rsplit("/", 1)[-1]
                try:
                    rows = _records(name, batch.column("content")[k].as_py())
                except Exception as e:
                    rows = iter([{"file": name, "error": f"{type(e).__name__}: {e}"}])
                while some := list(islice(rows, ROWS)):
                    yield pa.RecordBatch.from_pylist(some, schema=schema)

    empty = spark.createDataFrame([(name, "no content") for name in _empty(spark, path)], "file string, error string")
    return files.mapInArrow(parse, AUTH).unionByName(empty, allowMissingColumns=True)


def auth_records(reports: DataFrame) -> DataFrame:
    return reports.where("error is null").drop("error")


def auth_failures(reports: DataFrame) -> DataFrame:
    """Files that could not be read, and why."""
    return reports.where("error is not null").select("file", "error")

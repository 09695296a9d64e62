"""Rollup of mail-authentication reports (A2-A5). records: source_ip, count, disposition, dkim, spf, header_from, reporter,
begin, end, and the nested results auth_spf and auth_dkim (arrays of domain and result)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_V4 = r"^(\d{1,3})\.(\d{1,3})\.(\d{1,3})\.(\d{1,3})$"


FIELDS = ("spf", "dkim", "disposition")


def source_rollup(records: DataFrame) -> DataFrame:
    """Per source the messages, reporters, domains, first and last day of reports, the sets of domain=result that the checks
    found, and messages by result as maps; an absent result is '?', an absent domain adds nothing."""
    named = lambda field: F.array_distinct(F.flatten(F.collect_set(F.transform(F.filter(field, lambda x: F.coalesce(x["domain"], F.lit("")) != ""), lambda x: F.concat(x["domain"], F.lit("="), F.coalesce(x["result"], F.lit("?")))))))
    sums = records.groupBy("source_ip").agg(
        F.sum("count").alias("messages"), F.array_sort(F.collect_set("reporter")).alias("reporters"), F.array_sort(F.collect_set(F.nullif("header_from", F.lit("")))).alias("domains"), F.min("begin").alias("first_seen"), F.max("begin").alias("last_seen"),
        F.array_sort(named("auth_spf")).alias("spf_domains"), F.array_sort(named("auth_dkim")).alias("dkim_domains"),
    )
    kinds = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.coalesce(F.col(f), F.lit("?")).alias("result")) for f in FIELDS))).alias("r")
    counts = records.select("source_ip", "count", kinds).groupBy("source_ip", "r").agg(F.sum("count").alias("n"))
    entry = lambda f: F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("r.field") == f, F.struct("r.result", "n"))))).alias(f"{f}_results")
    return sums.join(counts.groupBy("source_ip").agg(*(entry(f) for f in FIELDS)), "source_ip")


def auth_tally(records: DataFrame) -> DataFrame:
    spf, dkim = (F.coalesce(F.col(x) == "pass", F.lit(False)) for x in ("spf", "dkim"))
    total = lambda cond, name: F.coalesce(F.sum(F.when(cond, F.col("count"))), F.lit(0).cast("long")).alias(name)
    return records.agg(F.coalesce(F.sum("count"), F.lit(0).cast("long")).alias("messages"), total(spf | dkim, "passed"), total(~(spf | dkim), "failed"), total(dkim & ~spf, "dkim_only"), total(spf & ~dkim, "spf_only"))


def ip_number(ip: Column) -> Column:
    """An IPv4 address as a number, or null."""
    parts = [F.regexp_extract(ip, _V4, k).try_cast("long") for k in range(1, 5)]
    fine = ip.rlike(_V4) & (F.greatest(*parts) <= 255)
    return F.when(fine, parts[0] * 16777216 + parts[1] * 65536 + parts[2] * 256 + parts[3])


def ip_hex(ip: Column) -> Column:
    """An IPv6 address as 32 hexadecimal digits, or null; '::' stands for the groups left out."""
    low = F.lower(ip)
    halves = F.split(low, "::")
    groups = lambda x: F.filter(F.split(x, ":"), lambda g: g != "")
    left, right = groups(halves[0]), F.when(F.size(halves) > 1, groups(F.get(halves, F.lit(1)))).otherwise(F.array().cast("array<string>"))
    missing = F.lit(8) - F.size(left) - F.size(right)
    full = F.concat(left, F.array_repeat(F.lit("0"), F.greatest(missing, F.lit(0))), right)
    fine = low.rlike("^[0-9a-f:]+$") & F.contains(low, F.lit(":")) & (F.size(halves) <= 2) & F.when(F.size(halves) == 2, missing >= 1).otherwise(missing == 0) & ~F.exists(full, lambda g: F.length(g) > 4)
    return F.when(fine, F.array_join(F.transform(full, lambda g: F.lpad(g, 4, "0")), ""))


def cidr_classify(ips: DataFrame, ranges: DataFrame) -> DataFrame:
    """listed, unlisted or unparseable for each ip. ranges: label and lo, hi as addresses of either kind.

    All addresses of a range begin with the digits that its ends share, so an address meets the ranges by its first
    digits, once for each number of digits that some range shares: 66 pairs of kind and number at most.
    """
    number = lambda c: F.coalesce(F.lpad(F.hex(ip_number(c)), 32, "0"), ip_hex(c))
    kind = lambda c: F.when(ip_number(c).isNotNull(), 4).when(ip_hex(c).isNotNull(), 6)
    nets = ranges.select("label", F.upper(number(F.col("lo"))).alias("lo"), F.upper(number(F.col("hi"))).alias("hi"), kind(F.col("lo")).alias("kind"))
    same = lambda i: F.substring("lo", i, F.lit(1)) == F.substring("hi", i, F.lit(1))
    shared = F.coalesce(F.get(F.filter(F.sequence(F.lit(1), F.lit(32)), lambda i: ~same(i)), F.lit(0)) - 1, F.lit(32))
    nets = nets.withColumn("digits", shared).withColumn("head", F.substring(F.col("lo"), F.lit(1), F.col("digits")))
    rows = ips.select("source_ip").distinct().withColumn("kind", kind(F.col("source_ip"))).withColumn("key", F.upper(number(F.col("source_ip"))))
    asked = rows.join(F.broadcast(nets.select("kind", "digits").distinct()), "kind").withColumn("head", F.substring(F.col("key"), F.lit(1), F.col("digits")))
    hits = asked.join(nets, ["kind", "digits", "head"]).where(F.col("key").between(F.col("lo"), F.col("hi"))).groupBy("source_ip").agg(F.min("label").alias("label"))
    state = F.when(F.col("key").isNull(), "unparseable").when(F.col("label").isNotNull(), "listed").otherwise("unlisted")
    return rows.join(hits, "source_ip", "left").select("source_ip", "label", state.alias("state"))


def policy_counts(reports: DataFrame) -> DataFrame:
    text = F.concat_ws("; ", *(F.concat(F.lit(f"{x}="), F.coalesce(F.col(x).cast("string"), F.lit("-"))) for x in ("domain", "p", "sp", "pct", "adkim", "aspf")))
    return reports.groupBy(text.alias("policy")).agg(F.count("*").alias("reports"))


def coverage(reports: DataFrame) -> DataFrame:
    return reports.groupBy("reporter").agg(F.count("*").alias("reports"), F.min("begin").alias("begin"), F.max("end").alias("end"))

"""Registration (WHOIS) signal: B4, B5, B27, B28, D5, H11, H12, A18."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import BULK_REGISTRARS, CLUSTER_EXEMPT_REGISTRARS, Settings
from ..functions.domains import parent_domain, suspicious_name
from ..functions.timeparts import age_days
from .skew import salted_join


def registration_signal(domains: DataFrame, records: DataFrame, cfg: Settings) -> DataFrame:
    """Current rule (B27): a looked-up record flags an age of 0..young_days;
    without a record the name heuristic decides.

    ``domains``: (domain); ``records``: (domain, created_date, registrar,
    registration_country, source).  Lookups are keyed by the parent site, as
    in the source; output keeps nulls for unknown age (sentinels come last).
    """
    d = domains.select("domain").withColumn("parent", parent_domain("domain"))
    r = records.select(F.col("domain").alias("parent"), "created_date", "registrar",
                       "registration_country", F.col("source").alias("whois_source"))
    j = d.join(r, "parent", "left")
    age = age_days("created_date", cfg.as_of)
    looked_up = F.col("whois_source").isNotNull() & (F.col("whois_source") != "heuristic")
    flag = (F.when(looked_up, F.coalesce(age.between(0, cfg.young_days), F.lit(False)))
            .otherwise(suspicious_name("parent")))
    return j.select(
        "domain",
        F.col("created_date"),
        F.when(looked_up, age).cast("int").alias("domain_age_days"),
        F.coalesce(F.substring("registrar", 1, 80), F.lit("unknown")).alias("registrar"),
        F.coalesce(F.substring("registration_country", 1, 50), F.lit("")).alias("registration_country"),
        F.coalesce("whois_source", F.lit("heuristic")).alias("whois_source"),
        flag.cast("int").alias("whois_flagged"),
    )


def registrar_clusters(reg: DataFrame, cfg: Settings, min_domains: int = 3) -> DataFrame:
    """Legacy rule (D5): registrar used by >= 3 domains and not exempt, or
    age in [0, 365).  The per-registrar count is a partial aggregation joined
    back with a salted join (a registrar can hold a third of all domains)."""
    counts = (reg.groupBy("registrar").agg(F.count(F.lit(1)).alias("registrar_domains")))
    j = salted_join(reg, counts, ["registrar"], "left", ["domain"], size_col="registrar_domains")
    clustered = (F.col("registrar_domains") >= min_domains) & \
        ~F.coalesce(F.col("registrar"), F.lit("")).isin(*CLUSTER_EXEMPT_REGISTRARS)
    young = F.coalesce(F.col("domain_age_days").between(0, cfg.legacy_young_days - 1), F.lit(False))
    return j.withColumn("registrar_clustered", clustered.cast("int")) \
            .withColumn("whois_flagged", (young | clustered).cast("int"))


def registration_repair(reg: DataFrame) -> DataFrame:
    """Repair rule (B28): unknown -> 0; age in [0, 365) -> 1; bulk registrar -> 1."""
    reg_l = F.lower(F.coalesce(F.col("registrar"), F.lit("unknown")))
    unknown = F.col("domain_age_days").isNull() | (F.col("domain_age_days") == -1) | (reg_l == "unknown")
    young = F.col("domain_age_days").between(0, 364)
    bulk = reduce(lambda a, b: a | b, [F.locate(s, reg_l) > 0 for s in BULK_REGISTRARS])
    return reg.withColumn("whois_flagged",
                          F.when(unknown, 0).when(young, 1).when(bulk, 1).otherwise(0))


def flatten_registration(raw: DataFrame, col: str = "record") -> DataFrame:
    """Flatten a registration JSON record (H12): top-level value, else the
    registry copy, else a default; first three name servers joined by ``|``."""
    schema = ("struct<createdDate:string, registrarName:string,"
              " registrant:struct<country:string>,"
              " nameServers:struct<hostNames:array<string>>,"
              " registryData:struct<createdDate:string, registrarName:string,"
              "   registrant:struct<country:string>, nameServers:struct<hostNames:array<string>>>>")
    r = F.from_json(F.col(col), schema)
    ns = F.coalesce(r["nameServers"]["hostNames"], r["registryData"]["nameServers"]["hostNames"],
                    F.array().cast("array<string>"))
    return raw.select(
        "*",
        F.coalesce(F.nullif(r["createdDate"], F.lit("")), F.nullif(r["registryData"]["createdDate"], F.lit("")),
                   F.lit("")).alias("created_raw"),
        F.substring(F.coalesce(F.nullif(r["registrarName"], F.lit("")),
                               F.nullif(r["registryData"]["registrarName"], F.lit("")),
                               F.lit("unknown")), 1, 80).alias("registrar"),
        F.substring(F.coalesce(F.nullif(r["registrant"]["country"], F.lit("")),
                               F.nullif(r["registryData"]["registrant"]["country"], F.lit("")),
                               F.lit("")), 1, 50).alias("registration_country"),
        F.concat_ws("|", F.slice(ns, 1, 3)).alias("nameservers"),
    )


def plan_lookups(domains: DataFrame, cache: DataFrame, used_today: int, limit: int) -> DataFrame:
    """Which domains to look up today (A18): not cached, suspicious name, at
    most ``limit - used_today`` of them (first by name, a distributed top-k);
    every other uncached domain falls back to the heuristic."""
    todo = domains.select("domain").join(cache.select("domain"), "domain", "left_anti")
    budget = max(int(limit) - int(used_today), 0)
    lookups = (todo.filter(suspicious_name("domain")).orderBy("domain").limit(budget)
               .select("domain", F.lit("lookup").alias("action")))
    rest = todo.join(lookups.select("domain"), "domain", "left_anti").select(
        "domain", F.lit("heuristic").alias("action"))
    return lookups.unionByName(rest)

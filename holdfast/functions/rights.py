"""Rights: URIs of licenses and rights statements, and the templates that say them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import urls

# Beginnings of URIs and the templates for them, in order; None stands for a license's own name.
STATEMENTS = "http://rightsstatements.org"
COMMONS = "http://creativecommons.org"
TEMPLATES = (
    (f"{STATEMENTS}/vocab/NKC/", "NKC"), (f"{STATEMENTS}/vocab/NoC-US/", "NoC-US"), (f"{COMMONS}/publicdomain/mark/", "PD-US"), (f"{COMMONS}/publicdomain/zero/", "cc-zero"),
    (f"{COMMONS}/licenses/by/", None), (f"{COMMONS}/licenses/by-sa/", None),
)


def license_name(uri: Column) -> Column:
    """A license's URI as a template's name; empty for what is no license."""
    found = F.regexp_extract(uri, rf"^{COMMONS}/licenses/(.*)", 1)
    dashed = F.replace(found, F.lit("/"), F.lit("-"))
    return F.when(uri.startswith(f"{COMMONS}/licenses/"), F.concat(F.lit("Cc-"), F.substr(dashed, F.lit(1), F.greatest(F.length(dashed) - 1, F.lit(0))))).otherwise("")


def permission_template(uri: Column) -> Column:
    """The template of the first beginning that fits; empty if none does."""
    out = F.lit("")
    for start, template in reversed(TEMPLATES):
        out = F.when(uri.startswith(start), license_name(uri) if template is None else F.lit(template)).otherwise(out)
    return out


def permission(uri: Column, template: Column, institution: Column) -> Column:
    """Rights statements name the institution that states them."""
    return F.when(uri.startswith(STATEMENTS), F.concat(template, F.lit(" | "), institution)).otherwise(template)


def read_rights(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object of URI -> {property: entity} as rows: uri (normalised), prop, qid.  A URI's first property counts."""
    whole = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,map<string,string>>")).alias("uri", "entry"))
    first = F.try_element_at(F.map_entries("entry"), F.lit(1))
    return whole.select(urls.rights_key(F.col("uri")).alias("uri"), first["key"].alias("prop"), first["value"].alias("qid")).where("prop is not null").dropDuplicates(["uri"])

"""JobPosting facts from JSON-LD blocks in HTML, over variants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.text import whole_json
from gleaner.runtime import stored

BLOCK = r"""(?is)<script[^>]*type=["']application/ld\+json["'][^>]*>(.*?)</script>"""
COUNTRIES = {"usa": "US", "united states": "US", "united states of america": "US", "uk": "GB", "united kingdom": "GB", "canada": "CA", "australia": "AU"}


def _is_posting(v: Column) -> Column:
    kind = F.coalesce(F.try_variant_get(v, "$['@type']", "string"), F.lit(""))
    kinds = F.coalesce(F.try_variant_get(v, "$['@type']", "array<string>"), F.array().cast("array<string>"))
    return (F.lower(kind) == "jobposting") | F.exists(kinds, lambda k: F.lower(k) == "jobposting")


def postings(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, path, node): every JobPosting node of the pages' JSON-LD blocks as JSON, where it stands in document order.

    Lists and ``@graph`` values are opened a level a round until none is left, however deep they
    lie; a posting isn't opened. Blocks that aren't JSON say nothing, null pages have no blocks.
    """
    blocks = pages.select(key, F.posexplode(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(BLOCK), F.lit(1))).alias("i", "block"))
    nodes = blocks.select(key, F.array("i").alias("path"), whole_json(F.trim("block")).alias("v")).where("v is not null")
    found = None
    while True:
        seen = stored(nodes.select(key, "path", F.to_json("v").alias("node"), _is_posting(F.col("v")).alias("hit")))
        hits = seen.where("hit").drop("hit")
        found = hits if found is None else found.unionByName(hits)
        v = F.parse_json("node")
        graph = F.try_variant_get(v, "$['@graph']", "variant")
        inner = F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.when(graph.isNotNull(), F.array(graph)))
        nodes = seen.where("not hit").select(key, "path", F.posexplode(inner).alias("i", "v")).select(key, F.concat("path", F.array("i")).alias("path"), "v").where("v is not null")
        if seen.where("not hit").where(F.size(inner) > 0).isEmpty():
            return found


def facts(node: Column) -> Column:
    """Location, country, salary, remote flag and date of a posting."""
    get = lambda path, kind="string": F.try_variant_get(node, path, kind)
    address = lambda part: F.coalesce(get(f"$.jobLocation.address.{part}"), get(f"$.jobLocation[0].address.{part}"))
    country = F.coalesce(address("addressCountry.name"), address("addressCountry"))
    table = F.create_map(*[F.lit(x) for pair in COUNTRIES.items() for x in pair])
    low = F.coalesce(get("$.baseSalary.value.minValue", "double"), get("$.baseSalary.value.value", "double"), get("$.baseSalary.value", "double"), get("$.baseSalary", "double"))
    return F.struct(
        F.nullif(F.concat_ws(", ", address("addressLocality"), address("addressRegion")), F.lit("")).alias("location"),
        F.coalesce(table[F.lower(F.trim(country))], F.when(F.length(F.trim(country)) == 2, F.upper(F.trim(country)))).alias("location_country"),
        low.alias("salary_min"), F.coalesce(get("$.baseSalary.value.maxValue", "double"), low).alias("salary_max"),
        F.when(get("$.jobLocationType") == "TELECOMMUTE", "remote").alias("is_remote"),
        F.nullif(F.regexp_extract(F.coalesce(get("$.datePosted"), F.lit("")), r"^(\d{4}-\d{2}-\d{2})", 1), F.lit("")).alias("date_posted"),
    )


def extracted(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, fact columns) of the first posting of each page that has one; rows that share a key are one page."""
    first = postings(pages, key, html).groupBy(key).agg(F.min_by("node", "path").alias("node"))
    return first.select(key, facts(F.parse_json("node")).alias("f")).select(key, "f.*")


def employment_type(seniority: Column | None) -> Column:
    full = F.lit("FULL_TIME")
    return full if seniority is None else F.when(seniority == "Intern", "INTERN").otherwise(full)


def posting_json(title: Column, description: Column, company: Column, posted: Column, seniority: Column | None = None, **optional: Column) -> Column:
    """A JobPosting document; absent values leave their key out."""
    return F.to_json(F.struct(
        F.lit("https://schema.org/").alias("@context"), F.lit("JobPosting").alias("@type"), title.alias("title"), description.alias("description"),
        F.struct(F.lit("Organization").alias("@type"), company.alias("name")).alias("hiringOrganization"), posted.cast("string").alias("datePosted"),
        F.date_add(posted, 30).cast("string").alias("validThrough"), employment_type(seniority).alias("employmentType"), *[v.alias(k) for k, v in optional.items()],
    ))

"""Deeply nested banners as flat tables that keep the link of each row to its record and parent.

One projection per target table: nested ``transform`` calls attach the ancestors' keys and the places in their arrays,
``flatten`` joins the levels, and one ``inline`` emits the rows. No shuffle is needed; a record's children are made in
the task that reads it.

Defined cases
    * absent, null and empty parts give no rows; places count from 0 over the array as it stands, nulls included.
    * the text of a CVE that is no JSON object has no children; an element that is no object gives no row but keeps its place.
    * columns of the input that share a name with an output column don't matter: only the nested ones are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A CVE's text, each level's elements still as text, so that one misshapen element doesn't spoil its neighbours.
CVE_SHAPE = "struct<references:string, affected:string>"


def _elements(text: Column) -> Column:
    """The elements, as JSON text, of an array given as JSON text; an empty array for anything else."""
    array = F.when(F.ltrim(text).startswith("["), F.from_json(text, "array<string>"))
    return F.coalesce(array, F.array().cast("array<string>"))


def _objects(elements: Column, make) -> Column:
    """make(element, place) for the elements that are objects."""
    placed = F.transform(elements, lambda e, i: F.struct(e.alias("e"), i.cast("long").alias("i")))
    return F.transform(F.filter(placed, lambda p: F.ltrim(p["e"]).startswith("{")), lambda p: make(p["e"], p["i"]))


def _cves() -> Column:
    return F.coalesce(F.map_entries("vulns"), F.array().cast("array<struct<key:string,value:string>>"))


def _part(text: Column, name: str) -> Column:
    return F.get_json_object(text, f"$.{name}")


def locations(records: DataFrame) -> DataFrame:
    """rec_id, city, region_code, country_code of the records with any of them."""
    return records.where("location.city is not null or location.region_code is not null or location.country_code is not null").select("rec_id", "location.city", "location.region_code", "location.country_code")


def hostnames(records: DataFrame) -> DataFrame:
    """rec_id, place, hostname."""
    named = F.filter(F.transform("hostnames", lambda h, i: F.struct(F.col("rec_id").alias("rec_id"), i.cast("long").alias("place"), h.alias("hostname"))), lambda r: r["hostname"] != "")
    return records.select(F.inline(named))


def vulns(records: DataFrame) -> DataFrame:
    """rec_id, cve, cvss (null where it is no number), verified, detail (the text)."""
    rows = F.transform(
        _cves(),
        lambda v: F.struct(F.col("rec_id").alias("rec_id"), v["key"].alias("cve"), _part(v["value"], "cvss").try_cast("double").alias("cvss"), _part(v["value"], "verified").try_cast("boolean").alias("verified"), v["value"].alias("detail")),
    )
    return records.select(F.inline(rows))


def references(records: DataFrame) -> DataFrame:
    """rec_id, cve, place, url, tags (an array)."""
    rows = F.flatten(
        F.transform(
            _cves(),
            lambda v: _objects(_elements(_part(v["value"], "references")), lambda e, i: F.struct(F.col("rec_id").alias("rec_id"), v["key"].alias("cve"), i.alias("place"), _part(e, "url").alias("url"), _elements(_part(e, "tags")).alias("tags"))),
        )
    )
    return records.select(F.inline(rows))


def affected(records: DataFrame) -> DataFrame:
    """rec_id, cve, place, product."""
    rows = F.flatten(
        F.transform(
            _cves(),
            lambda v: _objects(_elements(_part(v["value"], "affected")), lambda e, i: F.struct(F.col("rec_id").alias("rec_id"), v["key"].alias("cve"), i.alias("place"), _part(e, "product").alias("product"))),
        )
    )
    return records.select(F.inline(rows))


def ranges(records: DataFrame) -> DataFrame:
    """rec_id, cve, parent (place of the affected product), place, from_version, to_version."""
    rows = F.flatten(
        F.flatten(
            F.transform(
                _cves(),
                lambda v: _objects(
                    _elements(_part(v["value"], "affected")),
                    lambda e, i: _objects(
                        _elements(_part(e, "ranges")),
                        lambda r, j: F.struct(F.col("rec_id").alias("rec_id"), v["key"].alias("cve"), i.alias("parent"), j.alias("place"), _part(r, "from").alias("from_version"), _part(r, "to").alias("to_version")),
                    ),
                ),
            )
        )
    )
    return records.select(F.inline(rows))


TABLES = {"location": locations, "hostnames": hostnames, "vulns": vulns, "references": references, "affected": affected, "ranges": ranges}


def children(records: DataFrame) -> DataFrame:
    """rec_id, child, link: every row of the six tables by its link, as one projection over one scan."""
    rec, cves = F.col("rec_id"), _cves()

    def row(child: str, link: Column) -> Column:
        return F.struct(rec.alias("rec_id"), F.lit(child).alias("child"), link.alias("link"))

    def link(*parts: Column) -> Column:
        return F.concat_ws("/", *[p.cast("string") for p in parts])

    none = F.array().cast("array<struct<rec_id:bigint,child:string,link:string>>")
    place = F.when(F.coalesce("location.city", "location.region_code", "location.country_code").isNotNull(), F.array(row("location", F.lit("0"))))
    hosts = F.transform(F.filter(F.transform("hostnames", lambda h, i: F.struct(h.alias("h"), i.alias("i"))), lambda p: p["h"] != ""), lambda p: row("hostnames", link(p["i"])))
    cve = F.transform(cves, lambda v: row("vulns", v["key"]))
    refs = F.flatten(F.transform(cves, lambda v: _objects(_elements(_part(v["value"], "references")), lambda e, i: row("references", link(v["key"], i)))))
    both = F.flatten(
        F.transform(
            cves,
            lambda v: F.flatten(
                _objects(
                    _elements(_part(v["value"], "affected")),
                    lambda e, i: F.concat(F.array(row("affected", link(v["key"], i))), _objects(_elements(_part(e, "ranges")), lambda r, j: row("ranges", link(v["key"], i, j)))),
                )
            ),
        )
    )
    return records.select(F.inline(F.concat(*[F.coalesce(part, none) for part in (place, hosts, cve, refs, both)])))

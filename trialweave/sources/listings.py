"""JSON of a trial register: paged listings and nested detail documents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trialweave.functions import lists
from trialweave.operators.aggregates import dedup_keep_first
from trialweave.session import stage
from trialweave.sources import documents

# Fields of the listing and paths of the detail document.
LISTING_RECORD = (
    "struct<ctNumber:string,ctTitle:string,shortTitle:string,trialPhase:string,sponsor:string,"
    "sponsorType:string,therapeuticAreas:string,conditions:string,ageGroup:string,gender:string,"
    "totalNumberEnrolled:string,ctStatus:string>"
)
LISTING_PAGE = f"struct<pagination:struct<currentPage:bigint,totalPages:bigint>,data:array<{LISTING_RECORD}>>"
_INFO = "authorizedApplication.authorizedPartI.trialDetails.trialInformation"
DETAIL = (
    "struct<ctNumber:string,authorizedApplication:struct<authorizedPartI:struct<trialDetails:struct<"
    "trialInformation:struct<trialCategory:struct<trialPhase:string>,"
    "trialDuration:struct<estimatedRecruitmentStartDate:string,estimatedEndDate:string>,"
    "eligibilityCriteria:struct<"
    "principalInclusionCriteria:array<struct<principalInclusionCriteria:string>>,"
    "principalExclusionCriteria:array<struct<principalExclusionCriteria:string>>>>>>>>"
)


def last_page_wins(pages: DataFrame, body: str, page_schema: str, record_id: str, page_number: str,
                   records: str = "data") -> DataFrame:
    """One record per id from paged listings, taken from the last page that has it.

    ``page_number`` is the path of the number inside the page. Records without id go.
    """
    page = pages.select(F.from_json(F.col(body), page_schema).alias("page"))
    rows = page.select(
        F.col(f"page.{page_number}").alias("__page"),
        F.posexplode(f"page.{records}").alias("__place", "record"),
    ).where(F.col(f"record.{record_id}").isNotNull())
    flat = rows.select("__page", "__place", "record.*")
    latest = dedup_keep_first(
        flat, [record_id], [F.col("__page").desc_nulls_last(), F.col("__place").desc_nulls_last()]
    )
    return latest.drop("__page", "__place")


def pick_fields(document: Column, schema: str, paths: Mapping[str, str]) -> dict[str, Column]:
    """Named fields of a JSON document; a missing branch gives null."""
    parsed = F.from_json(document, schema)
    picked = {}
    for name, path in paths.items():
        field = parsed
        for step in path.split("."):
            field = field.getField(step)
        picked[name] = field
    return picked


DETAIL_PATHS = {
    "number": "ctNumber",
    "trial_phase": f"{_INFO}.trialCategory.trialPhase",
    "start_date": f"{_INFO}.trialDuration.estimatedRecruitmentStartDate",
    "end_date": f"{_INFO}.trialDuration.estimatedEndDate",
    "inclusion": f"{_INFO}.eligibilityCriteria.principalInclusionCriteria.principalInclusionCriteria",
    "exclusion": f"{_INFO}.eligibilityCriteria.principalExclusionCriteria.principalExclusionCriteria",
}
# Variants of a listing record and of a detail document, while their undeclared fields are not columns yet.
RECORD, DOCUMENT = "__record", "__document"


def open_records(pages: DataFrame, body: str, fields: Sequence[str], record_id: str, page_number: str, records: str = "data") -> DataFrame:
    """As ``last_page_wins`` with text fields, and each record as a variant that keeps the keys nobody declared."""
    page = pages.select(documents.parsed(F.col(body)).alias("page"))
    listed = F.try_variant_get("page", documents.json_path(records.split(".")), "array<variant>")
    rows = page.select(
        documents.field(F.col("page"), page_number.split("."), "bigint").alias("__page"),
        F.posexplode(listed).alias("__place", RECORD))
    flat = rows.select("__page", "__place", RECORD, *[documents.field(F.col(RECORD), [f]).alias(f) for f in fields])
    latest = dedup_keep_first(flat.where(F.col(record_id).isNotNull()), [record_id], [F.desc_nulls_last("__page"), F.desc_nulls_last("__place")])
    return latest.drop("__page", "__place")


def newest_documents(details: DataFrame, body: str, url: str, fetched: str | None, keep: bool) -> DataFrame:
    """Fields of the newest document per trial; of documents fetched at one time the greatest by digest. Unreadable ones go."""
    fields = pick_fields(F.col(body), DETAIL, DETAIL_PATHS)
    rows = details.select(
        *[c.alias(n) for n, c in fields.items()], F.col(url).alias("url"), F.md5(F.col(body)).alias("__digest"),
        (F.col(fetched) if fetched else F.lit(0)).alias("__fetched"), *([documents.parsed(F.col(body)).alias(DOCUMENT)] if keep else []))
    order = [F.desc_nulls_last("__fetched"), F.desc("__digest")]
    return dedup_keep_first(rows.where("number IS NOT NULL"), ["number"], order).drop("__fetched", "__digest")


def newer_register(pages: DataFrame, page_body: str, details: DataFrame, detail_body: str,
                   url: str = "url", fetched: str | None = None, undeclared: bool = False, limit: int = 500) -> DataFrame:
    """Records of the newer EU register from its listing pages and detail documents.

    Of several documents of one trial the newest counts, by the column ``fetched``. With ``undeclared`` every field of records
    and documents that this module does not name comes too, as text columns ``listing.*`` and ``detail.*``; two jobs learn
    their names, and more than ``limit`` of either are an error.
    """
    if undeclared:
        names = [f.name for f in T.DataType.fromDDL(LISTING_RECORD).fields]
        listed = open_records(pages, page_body, names, "ctNumber", "pagination.currentPage")
    else:
        listed = last_page_wins(pages, page_body, LISTING_PAGE, "ctNumber", "pagination.currentPage")
    detail = newest_documents(details, detail_body, url, fetched, undeclared)

    def criteria(name: str) -> Column:
        return F.when(F.size(name) > 0, F.to_json(F.transform(name, lambda x: F.coalesce(x, F.lit("")))))

    # A listed trial whose document is missing or unreadable stays, with what the listing says.
    found = listed.join(detail, listed["ctNumber"] == detail["number"], "left").select(
        F.col("ctTitle").alias("title"),
        F.col("ctNumber").alias("eudract_nr"),
        "trial_phase",
        F.col("trialPhase").alias("trial_phase_desc"),
        "start_date",
        "end_date",
        F.col("shortTitle").alias("Protocol"),
        F.col("sponsor").alias("Sponsor"),
        F.col("sponsorType").alias("Sponsor_type"),
        F.col("therapeuticAreas").alias("therapeutic_area"),
        F.col("conditions").alias("condition"),
        F.col("ageGroup").alias("Age"),
        F.col("gender").alias("Gender"),
        criteria("inclusion").alias("inclusion_crt"),
        criteria("exclusion").alias("exclusion_crt"),
        F.col("totalNumberEnrolled").alias("nr_enrolled"),
        "url",
        F.col("ctStatus").alias("status"),
        *([RECORD, DOCUMENT] if undeclared else []),
    )
    if undeclared:
        found = stage(found, "open-register")
        found = documents.with_undeclared(found, RECORD, [(n,) for n in names], "listing", limit)
        found = documents.with_undeclared(found, DOCUMENT, [tuple(p.split(".")) for p in DETAIL_PATHS.values()], "detail", limit)
        found = found.drop(RECORD, DOCUMENT)
    return found


def header_map(df: DataFrame, headers: str, cells: str, fields: list[str]) -> DataFrame:
    """Row cells as named columns by the place of their header."""
    named = lists.zip_fields(F.col(headers), F.col(cells), fields)
    return df.select(*[c for c in df.columns if c not in (headers, cells)],
                     *[c.alias(n) for n, c in named.items()])

"""Identity keys of postings and degrees."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _some(col: str) -> Column:
    """The trimmed value, null if there is none."""
    return F.nullif(F.trim(F.col(col)), F.lit(""))


def _place() -> Column:
    parts = [_some("municipality"), _some("island"), _some("province")]
    return F.coalesce(_some("raw_location"), F.nullif(F.concat_ws(" / ", *parts), F.lit("")), F.lit(""))


def storage_key(lower_source: bool = True, full_place: bool = True) -> Column:
    """The address, else source and id, else what describes the posting; null if nothing identifies it."""
    source = F.coalesce(_some("source"), F.lit(""))
    source = F.lower(source) if lower_source else source
    place = _place() if full_place else F.coalesce(_some("raw_location"), _some("municipality"), F.lit(""))
    title, company = F.lower(F.coalesce(_some("title"), F.lit(""))), F.lower(F.coalesce(_some("company"), F.lit("")))
    date = F.coalesce(_some("publication_date"), F.lit(""))
    row = F.concat_ws("::", F.lit("row"), source, title, company, F.lower(date), F.lower(place))
    return F.coalesce(
        F.concat(F.lit("url::"), F.lower(_some("source_url"))),
        F.when(source != "", F.concat(F.lit("id::"), source, F.lit("::"), _some("external_id"))),
        F.when((title != "") | (company != ""), row),
    )


def secondary_key() -> Column:
    """Source, title, company, date and place; null unless all but the place are there."""
    parts = [_some(c) for c in ("source", "title", "company", "publication_date")]
    key = F.lower(F.concat_ws("::", F.lit("sec"), *parts, _place()))
    complete = parts[0].isNotNull() & parts[1].isNotNull() & parts[2].isNotNull() & parts[3].isNotNull()
    return F.when(complete, key)


def payload_hash(columns: list[str], leave_out: tuple[str, ...] = ("scraped_at",)) -> Column:
    """SHA-256 of the columns in alphabetical order as JSON, nulls included."""
    kept = sorted(c for c in columns if c not in leave_out)
    return F.sha2(F.to_json(F.struct(*kept), {"ignoreNullFields": "false"}), 256)


def job_key(ordinal: Column) -> Column:
    """For alignment the id comes first, then the address, then the row."""
    source = F.lower(F.coalesce(_some("source"), F.lit("unknown")))
    return F.coalesce(
        F.when(_some("external_id").isNotNull(), F.concat_ws("::", F.lit("job"), source, _some("external_id"))),
        F.when(_some("source_url").isNotNull(), F.concat(F.lit("job_url::"), _some("source_url"))),
        F.concat_ws("::", F.lit("job_row"), source, ordinal.cast("string")),
    )


def degree_key(ordinal: Column) -> Column:
    source = F.lower(F.coalesce(_some("source"), F.lit("unknown")))
    title = F.lower(F.coalesce(_some("title"), F.lit("")))
    return F.coalesce(
        F.when(_some("source_id").isNotNull(), F.concat_ws("::", F.lit("degree"), source, _some("source_id"))),
        F.concat_ws("::", F.lit("degree_row"), source, title, ordinal.cast("string")),
    )


def pair_key() -> Column:
    return F.concat_ws("::", "job_key", "degree_key", "provider", "model")


def catalogue_key() -> Column:
    """University, title and type, lower case."""
    return F.concat_ws(
        "\u001f", F.lower(F.coalesce("university", F.lit(""))), F.lower(F.coalesce("title", F.lit(""))),
        F.lower(F.coalesce("title_type", F.lit(""))),
    )


def stable_source_id(university: Column, title: Column, url: Column) -> Column:
    return F.concat(university, F.lit("_"), F.substring(F.sha1(F.concat_ws("|", title, url)), 1, 12))


def posting_id(url: Column) -> Column:
    """The id in an address of a posting, else a hash of the address."""
    found = F.nullif(F.regexp_extract(url, r"/job/(?:[^/]+/)?([a-zA-Z0-9]+)", 1), F.lit(""))
    return F.coalesce(found, F.substring(F.sha1(url), 1, 16))

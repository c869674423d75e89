"""Object URIs, storage keys, bucket names and marker keys as column expressions.

Every builder yields null when one of its parts is blank, so a bad row is a
row with a null key (see ``blank_part``) and never a failed task.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import clean, clean_lower, is_blank

# The storage layout both sides of an exchange agree on.
MARKER_SUFFIX = ".done"
BUCKET_PURPOSES = ("staging", "landing", "target")
RECEIVER_PURPOSES = ("landing", "target")


def _text(value: Column | str) -> Column:
    return F.lit(value) if isinstance(value, str) else value


def blank_part(*parts: Column) -> Column:
    """True when any path component is null or blank."""
    broken = F.lit(False)
    for part in parts:
        broken = broken | is_blank(part)
    return broken


def _join_parts(parts: list[Column], separator: str = "/") -> Column:
    joined = F.concat_ws(separator, *[clean(part) for part in parts])
    return F.when(~blank_part(*parts), joined)


def outgoing_prefix(mode: str) -> str:
    return f"{mode}_mode/outgoing/"


def processed_prefix(mode: str) -> str:
    return f"{mode}_mode/processed/"


def transfer_path(mode: Column, session: Column, file_name: Column) -> Column:
    return _join_parts([F.concat(mode, F.lit("_mode")), F.lit("transfers"), session, file_name])


def transfer_prefix(mode: Column, session: Column) -> Column:
    return F.concat(_join_parts([F.concat(mode, F.lit("_mode")), F.lit("transfers"), session]), F.lit("/"))


def landing_path(session: Column, file_name: Column, agency: Column | None = None) -> Column:
    """Agency-scoped landing key; a null agency falls back to the shared ``landing`` folder."""
    if agency is None:
        return _join_parts([F.lit("landing"), session, file_name])
    return _join_parts([F.when(agency.isNull(), F.lit("landing")).otherwise(agency), session, file_name])


def extracted_path(session: Column, file_name: Column) -> Column:
    return _join_parts([F.lit("extracted"), session, file_name])


def target_path(agency: Column, session: Column, member: Column) -> Column:
    return F.concat(F.lit("transfers/"), agency, F.lit("/"), session, F.lit("/"), member)


def bucket_name(
    environment: Column,
    agency: Column,
    purpose: Column,
    prefix: str = "exchange",
    allowed_purposes: tuple[str, ...] = BUCKET_PURPOSES,
) -> Column:
    """``{prefix}-{environment}-{agency}-data-{purpose}`` in lower case, null when a part is invalid."""
    name = F.concat_ws(
        "-", F.lit(prefix), clean_lower(environment), clean_lower(agency), F.lit("data"), F.lower(purpose)
    )
    return F.when(~blank_part(environment, agency) & F.lower(purpose).isin(*allowed_purposes), name)


def base_name(key: Column) -> Column:
    """Last component of a key; slashes at the end do not count."""
    return F.substring_index(F.rtrim(key, F.lit("/")), "/", -1)


def file_marker_key(key: Column) -> Column:
    """Processed-marker key of an outgoing file.

    The outgoing prefix is swapped for the processed one, at the start of the
    key or below a leading folder, so files in sub-folders keep their path. A
    key outside the outgoing area gets a marker by its base name.
    """
    outgoing, processed = outgoing_prefix("file"), processed_prefix("file")
    inner = F.locate("/" + outgoing, key)
    swapped = F.concat(
        F.substring(key, F.lit(1), inner),
        F.lit(processed),
        F.substring(key, inner + F.lit(1 + len(outgoing)), F.length(key)),
    )
    marker = (
        F.when(key.startswith(outgoing), F.concat(F.lit(processed), F.substring(key, len(outgoing) + 1, 1 << 30)))
        .when(inner > 0, swapped)
        .otherwise(F.concat(F.lit(processed), base_name(key)))
    )
    return F.concat(marker, F.lit(MARKER_SUFFIX))


def query_marker_key(template_id: Column | str, fingerprint: Column) -> Column:
    folder = F.lit(processed_prefix("query").rstrip("/"))
    return F.concat(_join_parts([folder, _text(template_id), fingerprint]), F.lit(MARKER_SUFFIX))


def session_marker_key(agency: Column, session: Column, kind: Column | str = "done") -> Column:
    return F.concat(F.lit("processed/"), agency, F.lit("/"), session, F.lit("."), _text(kind))


def extract_key(session: Column, template_id: Column | str, fingerprint: Column) -> Column:
    """Key of a staged query result."""
    return F.concat(
        F.lit(outgoing_prefix("query")), session, F.lit("/"), _text(template_id), F.lit("_"),
        F.substring(fingerprint, 1, 12), F.lit("_results.csv"),
    )


def parse_object_uri(uri: Column, scheme: str = "s3") -> Column:
    """``struct(bucket, key, status)``; status is ``ok``, ``invalid`` or ``other_scheme``.

    The scheme is case-sensitive, as object stores treat it.
    """
    lead = f"{scheme}://"
    rest = F.substring(uri, len(lead) + 1, 1 << 30)
    slash = F.locate("/", rest)
    bucket = F.substring(rest, F.lit(1), slash - 1)
    key = F.substring(rest, slash + 1, F.length(rest))
    status = (
        F.when(uri.isNull() | ~uri.startswith(lead), F.lit("other_scheme"))
        .when((slash > 1) & (key != ""), F.lit("ok"))
        .otherwise(F.lit("invalid"))
    )
    return F.struct(
        F.when(status == "ok", bucket).alias("bucket"),
        F.when(status == "ok", key).alias("key"),
        status.alias("status"),
    )


def marker_directory(bucket: Column, key: Column) -> Column:
    """URI of the folder that holds a key."""
    slash = F.length(key) - F.length(F.substring_index(key, "/", -1))
    return F.concat(F.lit("s3://"), bucket, F.lit("/"), F.substring(key, F.lit(1), slash))


def member_name_violation(name: Column) -> Column:
    """Why an archive member name is unsafe, or null.

    A name may not be empty, a lone dot, absolute, or hold ``..`` as a part, so
    that the extracted path always stays below the target folder.
    """
    return (
        F.when(name.isNull() | (name == ""), F.lit("empty"))
        .when(name.isin(".", ".."), F.lit("dot_name"))
        .when(name.startswith("/"), F.lit("absolute"))
        .when(F.array_contains(F.split(name, "/"), ".."), F.lit("traversal"))
    )


def session_id(created_at: Column, key: Column) -> Column:
    """``yyyyMMdd-HHmmss-xxxxxxxx`` with a suffix derived from a row key, so that a retry agrees."""
    return F.concat(
        F.date_format(created_at, "yyyyMMdd-HHmmss"), F.lit("-"),
        F.substring(F.sha2(key.cast("string"), 256), 1, 8),
    )

"""Checksums, canonical parameter text and request fingerprints."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

FINGERPRINT_VERSION = "fp1"
SHORT_LENGTH = 12
HEX_SHA256 = "^[0-9a-fA-F]{64}$"


def sha256_hex(content: Column) -> Column:
    return F.sha2(content, 256)


def short_fingerprint(fingerprint: Column, length: int = SHORT_LENGTH) -> Column:
    return F.substring(fingerprint, 1, length)


def hex_checksum(checksum: Column) -> Column:
    """The checksum in lower case when it is 64 hex characters, else null."""
    return F.when(checksum.rlike(HEX_SHA256), F.lower(checksum))


def canonical_params(params: Column) -> Column:
    """Canonical text of a JSON object: sorted keys at every depth, list order kept.

    A variant stores object fields in key order and prints numbers in one form;
    the value types are appended so that ``1`` and ``1.0`` stay different.
    """
    value = F.try_parse_json(params)
    return F.concat(F.to_json(value), F.lit(" "), F.schema_of_variant(value))


@dataclass(frozen=True)
class SourceIdentity:
    """Where an extract reads from. A password is not part of the identity."""

    engine: str = "parquet"
    host: str = ""
    port: str = ""
    database: str = ""
    user: str = ""

    def parts(self) -> list[str]:
        return [self.engine.strip().lower(), self.host, self.port, self.database, self.user]


def fingerprint(
    params: Column,
    template_id: Column | str,
    row_limit: Column,
    timeout_seconds: Column,
    source: SourceIdentity = SourceIdentity(),
) -> Column:
    """SHA-256 over everything that changes an extract's result.

    Session, product and request ids are left out on purpose: the same extract
    asked for twice is the same work. The parts go in as a JSON list, so no
    separator inside a value can make two different requests equal.
    """
    template = F.lit(template_id) if isinstance(template_id, str) else template_id
    parts = [F.lit(FINGERPRINT_VERSION)] + [F.lit(part) for part in source.parts()]
    parts += [template, row_limit.cast("string"), timeout_seconds.cast("string"), canonical_params(params)]
    return F.sha2(F.to_json(F.array(*[F.coalesce(part, F.lit("")) for part in parts])), 256)


def scoped_fingerprint(
    scope: Column, dataproduct_id: Column, request_id: Column, requester: Column, params: Column
) -> Column:
    """Identity of a request under its product's declared idempotency scope; unknown scope gives null."""
    canon = canonical_params(params)
    keyed = (
        F.when(scope == "dataproduct_plus_params", F.array(scope, dataproduct_id, canon))
        .when(scope == "request_id", F.array(scope, request_id))
        .when(scope == "requester_plus_params", F.array(scope, requester, canon))
    )
    return F.sha2(F.to_json(keyed), 256)

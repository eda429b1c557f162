"""Typing namespaces: which assignments may be compared at all."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lineagespark import constants as C
from lineagespark.functions.text import clean, is_one_of

_SHA256 = r"^[0-9a-f]{64}$"


def typing_scope(scheme, version, database_sha256, export_hashes=()) -> Column:
    """Struct(scheme, version), null when either is missing.

    A missing version becomes the database fingerprint or, where ``export_hashes`` are given
    (lineage codes), the first export file hash.
    """
    digest = F.lower(clean(database_sha256))
    fallback = F.when(digest.rlike(_SHA256), F.concat(F.lit("sha256:"), digest))
    for column in export_hashes:
        text = F.lower(clean(column))
        fallback = F.coalesce(fallback, F.when(text.rlike(_SHA256), F.concat(F.lit("exportsha256:"), text)))
    own = F.when(~is_one_of(version, C.MISSING_TYPING), clean(version))
    found = F.coalesce(own, fallback)
    return F.when(
        ~is_one_of(scheme, C.MISSING_TYPING) & found.isNotNull(),
        F.struct(clean(scheme).alias("scheme"), found.alias("version")),
    )


def hashes_agree(left, right) -> Column:
    """True unless both fingerprints are present and differ. Not transitive."""
    a, b = F.lower(clean(left)), F.lower(clean(right))
    return (a == "") | (b == "") | (a == b)


def compatible(left_scope, right_scope, left_hash, right_hash) -> Column:
    return left_scope.eqNullSafe(right_scope) & hashes_agree(left_hash, right_hash)

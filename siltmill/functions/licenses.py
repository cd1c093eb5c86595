"""License types as expressions, and which files are license files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Identifiers that change no license's type, the identifier of an unresolved reference, and the names
# of files that licenses are looked for in.
AMENDMENTS = (
    "LicenseRef-scancode-dco-1.1",
    "LicenseRef-scancode-generic-cla",
    "LicenseRef-scancode-google-cla",
    "LicenseRef-scancode-jetty-ccla-1.1",
    "LicenseRef-scancode-newton-king-cla",
    "LicenseRef-scancode-generic-exception",
    "LicenseRef-scancode-generic-export-compliance",
    "LicenseRef-scancode-generic-tos",
    "LicenseRef-scancode-generic-trademark",
    "LicenseRef-scancode-warranty-disclaimer",
)
UNKNOWN_REFERENCE = "LicenseRef-scancode-unknown-license-reference"
LICENSE_FILES = (
    r"li[cs]en[cs]e(s?)",
    r"legal",
    r"copy(left|right|ing)",
    r"unlicense",
    r"[al]?gpl([-_ v]?)(\d\.?\d?)?",
    r"bsd(l?)",
    r"mit(x?)",
    r"apache",
    r"artistic",
    r"copying(v?)(\d?)",
    r"disclaimer",
    r"eupl",
    r"gfdl",
    r"[cm]pl",
    r"cc0",
    r"al([-_ v]?)(\d\.?\d)?",
    r"about",
    r"notice",
    r"readme",
    r"guidelines",
)
LICENSE_FILE = f"(?i)^(|.*[-_. ])({'|'.join(LICENSE_FILES)})(|[-_. ].*)$"
# End of fixed values.


def is_license_file(name: Column) -> Column:
    return name.rlike(LICENSE_FILE)


def any_license_file(names: Column) -> Column:
    return F.exists(names, is_license_file)


def license_type(repo_license: Column, detected: Column, permissive: Sequence[str], amendments: Sequence[str] = AMENDMENTS) -> Column:
    """permissive, non_permissive or no_license, from a repository's own license and those found in its files."""
    found = F.coalesce(detected, F.array().cast("array<string>"))
    good = F.array_intersect(found, F.array(*map(F.lit, permissive)))
    other = F.array_except(found, F.array(*map(F.lit, (*permissive, *amendments))))
    bad = F.when(F.size(good) > 0, F.array_remove(other, UNKNOWN_REFERENCE)).otherwise(other)
    return (
        F.when(repo_license.isin(*permissive), "permissive")
        .when(repo_license.isNotNull() & (repo_license != "NOASSERTION"), "non_permissive")
        .when(F.size(found) == 0, F.when(repo_license.isNull(), "no_license").otherwise("non_permissive"))
        .when(F.size(bad) > 0, "non_permissive")
        .when(F.size(good) > 0, "permissive")
        .otherwise("no_license")
    )


#: License lines in texts and their identifiers: a table of rules in place of a trained detector.
LICENSE_LINES = (
    ("MIT", r"MIT License"),
    ("Apache-2.0", r"Apache License,? Version 2\.0"),
    ("GPL-3.0", r"GNU General Public License,? version 3"),
    ("CC-BY-NC-4.0", r"CC BY-NC 4\.0"),
)


def detected_licenses(text: Column, rules: Sequence[tuple[str, str]] = LICENSE_LINES) -> Column:
    """Identifiers of the rules that a text matches, in the rules' order."""
    return F.array_compact(F.array(*[F.when(text.rlike(pattern), F.lit(name)) for name, pattern in rules]))

"""Free-form licence fields to identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fields that say nothing.
JUNK = ["", "Unknown", "unknown", "LICENSE", "LICENSE.txt", "LICENSE.md", "License", "License.txt", "License.md", "license", "license.txt"]

# What a field in lower case must be like, and the identifier it then has; the first that holds counts.
RULES: list[tuple[str, str, str | None]] = [
    ("starts", "complete terms in", None),
    ("has", "mit-0", "MIT-0"),
    ("regex", "^mit($|\\s|\\.|,|;)", "MIT"),
    ("is", "apache2", "Apache-2.0"),
    ("regex", "apache.*2|2.*apache", "Apache-2.0"),
    ("regex", "bsd-3-clause|3-clause bsd|3 clause bsd", "BSD-3-Clause"),
    ("regex", "bsd-2-clause|2-clause bsd", "BSD-2-Clause"),
    ("is", "0bsd", "0BSD"),
    ("is", "bsd", "BSD"),
    ("is", "isc", "ISC"),
    ("regex", "mpl-2\\.0|^mpl$", "MPL-2.0"),
    ("regex", "cc0|cc-0", "CC0-1.0"),
    ("has", "unlicense", "Unlicense"),
    ("has", "wtfpl", "WTFPL"),
    ("has", "mulan", "Mulan-PSL-2.0"),
    ("has", "agpl", "AGPL-3.0"),
    ("has", "lgpl", "LGPL-3.0"),
    ("has", "gpl", "GPL-3.0"),
    ("regex", "cc[- ]by-nc", "CC-BY-NC-4.0"),
    ("regex", "cc[- ]by-nd", "CC-BY-ND-4.0"),
    ("regex", "cc[- ]by-sa", "CC-BY-SA-4.0"),
    ("regex", "cc[- ]by", "CC-BY-4.0"),
    ("regex", "proprietary|private", "Proprietary"),
    ("has", "fsl", "FSL-1.1"),
    ("has", "polyform", "PolyForm-NC-1.0"),
    ("has", "busl", "BUSL-1.1"),
]


def licence_id(field: Column) -> Column:
    """The identifier a licence field names, null where it names none."""
    text = F.trim(field)
    low = F.lower(text)
    test = {"starts": low.startswith, "has": low.contains, "regex": low.rlike, "is": lambda v: low == v}
    out = F.when(text.isNull() | text.isin(JUNK), F.lit(None).cast("string"))
    for kind, value, name in RULES:
        out = out.when(test[kind](value), F.lit(name).cast("string"))
    return out.otherwise(F.lit(None).cast("string"))


# The tiers of licences, and the states that are none.
GREEN = ["Apache-2.0", "BSD", "BSD-2-Clause", "BSD-3-Clause", "0BSD", "CC0-1.0", "ISC", "MIT", "MIT-0", "MPL-2.0", "Mulan-PSL-2.0", "Unlicense", "WTFPL"]
RED = [
    "AGPL-1.0", "AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "GPL-2.0", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later", "CC-BY-NC-4.0",
    "CC-BY-NC-SA-4.0", "CC-BY-ND-4.0", "FSL-1.1", "FSL-1.1-MIT", "FSL-1.1-Apache-2.0", "PolyForm-NC-1.0", "PolyForm-Noncommercial-1.0.0", "BUSL-1.1", "Proprietary",
]
YELLOW = ["LGPL-2.1", "LGPL-3.0", "LGPL-3.0-only", "CC-BY-SA-4.0", "CC-BY-4.0", "EPL-2.0"]
MISSING = ["NO_LICENSE", "SOURCE_NOT_FETCHED", "Custom", "NOASSERTION"]


def licence_tier(identifier: Column) -> Column:
    """The tier of a licence identifier; a null is OTHER."""
    return F.when(identifier.isin(GREEN), "GREEN").when(identifier.isin(RED), "RED").when(identifier.isin(YELLOW), "YELLOW").when(identifier.isin(MISSING), "MISSING").otherwise("OTHER")

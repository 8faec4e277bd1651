"""Column functions on text and numbers. Patterns are Java's, made Unicode-aware and blind to odd line ends."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rx(pattern: str, flags: str = "i") -> str:
    return f"(?dU{flags}){pattern}"


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def nonempty(text: Column) -> Column:
    """Null for the empty text. Unlike ``nullif``, which inside a lambda computes its text twice, it computes it once."""
    return let(text, lambda t: F.when(t != "", t))


def has(text: Column, pattern: str, flags: str = "i") -> Column:
    return text.rlike(rx(pattern, flags))


def first(text: Column, pattern: str, group: int = 1, flags: str = "i") -> Column:
    """The group in the first match; null where nothing, or nothing in the group, matched."""
    return nonempty(F.regexp_extract(text, rx(pattern, flags), group))


def every(text: Column, pattern: str, group: int = 1, flags: str = "i") -> Column:
    return F.regexp_extract_all(text, F.lit(rx(pattern, flags)), F.lit(group))


def replace(text: Column, pattern: str, by: str = "", flags: str = "i") -> Column:
    return F.regexp_replace(text, rx(pattern, flags), by)


def filled(text: Column) -> Column:
    """Null for blank text."""
    return nonempty(F.trim(text))


#: Units of Indian amounts.
LAKH, CRORE = 100_000, 10_000_000


def number(text: Column, unit: Column | None = None) -> Column:
    """The digits and points of a text as a number, times lakh or crore if its unit says so; else null."""
    value = F.regexp_replace(text, "[^0-9.]", "").try_cast("double")
    if unit is None:
        return value
    return value * let(unit, lambda u: F.when(has(u, r"\b(lakh|lac)"), float(LAKH)).when(has(u, r"\b(crore|cr\b)"), float(CRORE)).otherwise(1.0))


def slug(text: Column, sep: str = "-", empty: str | None = "unknown") -> Column:
    """Lower-case runs of a-z and 0-9 joined by ``sep``."""
    out = F.array_join(F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+"), lambda x: x != ""), sep)
    out = nonempty(out)
    return out if empty is None else F.coalesce(out, F.lit(empty))


def word_set(text: Column, least: int = 3) -> Column:
    """Distinct a-z0-9 words of at least ``least`` letters."""
    return F.array_distinct(F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+"), lambda x: F.length(x) >= least))


def around(text: Column, pattern: str | Column, before: int, after: int, flags: str = "i") -> Column:
    """The first match with its surroundings, on one line. A Column is a pattern with its flags."""
    wanted = F.lit(rx(pattern, flags)) if isinstance(pattern, str) else pattern
    found = F.struct(F.regexp_instr(text, wanted).alias("at"), F.length(F.regexp_substr(text, wanted)).alias("size"))

    def cut(m: Column) -> Column:
        lead = F.least(F.lit(before), m["at"] - 1)
        return F.when(m["at"] > 0, F.trim(F.translate(F.substring(text, m["at"] - lead, lead + m["size"] + after), "\n", " ")))

    return let(found, cut)


def first_line(text: Column, within: int = 200) -> Column:
    return F.substring_index(F.substring(text, 1, within), "\n", 1)


#: Invitations to click, which say nothing of a product.
INVITATIONS = ("click here", "know more", "read more", "learn more", "view more", "view less", "view details", "opens in a new tab", "open in a new tab")
_FILES = ("pdf", "html", "aspx", "php", "jpg", "png", "webp")
#: A markdown link or image, whole or cut off by the end of the text: mark, label, target.
_LINK = r"(!?)\[([^\[\]]*)(?:\](?:\(\s*[^()\s]*[^()]*(?:\)|$))?|$)"


def unlinked(text: Column) -> Column:
    """Markdown links by their labels, images by nothing, emphasis marks by spaces."""
    bare = F.regexp_replace(F.regexp_replace(text, r"!\[[^\[\]]*\](?:\([^()]*\))?", " "), _LINK, "$2")
    return F.translate(bare, "*_`#|[]", "       ")


def clauses(text: Column) -> Column:
    """The lines and sentences of a text, markdown taken off; "Rs." ends no sentence."""
    return F.filter(F.transform(F.split(unlinked(text), r"\n|;|(?<!\b[Rr][Ss])\.(?=\s|$)"), lambda x: F.trim(x)), lambda x: x != "")


def snippet(text: Column, limit: int = 250) -> Column:
    """Display text: words without markup, addresses, file names and invitations, cut at a word beyond ``limit``."""
    heads = F.regexp_replace(text, r"(?im)^(?:title|url source|markdown content):.*$", " ")
    said = F.regexp_replace(unlinked(heads), f"(?i)\\b(?:{'|'.join(INVITATIONS)})\\b", " ")
    address = rf"(?i)^\(?https?:|\.(?:{'|'.join(_FILES)})\)?$"
    line = F.array_join(F.filter(F.split(said, r"\s+"), lambda w: (w != "") & ~w.rlike(address)), " ")

    def short(t: Column) -> Column:
        head = F.substring(t, 1, limit)
        whole = F.length(head) - F.length(F.substring_index(head, " ", -1)) - 1
        return F.when(F.length(t) <= limit, t).when(whole > 0.6 * limit, F.substring(head, F.lit(1), whole)).otherwise(head)

    return F.btrim(let(line, short), F.lit(" :>–—-[("))

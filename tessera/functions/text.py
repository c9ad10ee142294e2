"""Text and name functions as Column expressions; all stay inside the JVM."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: UTF-8 umlauts read as Mac Roman, and what they stand for.
MOJIBAKE = {
    "√º": "ü", "√∂": "ö", "√§": "ä", "√ú": "Ü", "√ñ": "Ö", "√Ñ": "Ä",
    "√ü": "ß", "√©": "é", "√®": "è", "√°": "á", "√¥": "ô", "√¢": "â",
}
#: Soft hyphen, zero-width space, non-joiner, joiner, byte order mark.
ZERO_WIDTH = "\u00ad\u200b\u200c\u200d\ufeff"
#: Headings that open a reference tail.
REFERENCE_HEADINGS = (
    "references", "reference", "bibliography", "notes", "footnotes", "sources", "works cited", "further reading",
    "external links", "citations", "see also", "literature", "literatur", "weblinks", "einzelnachweise", "quellen",
)
#: Articles and possessives that stopword matching ignores at the start.
DETERMINERS = (
    "der", "die", "das", "den", "dem", "des", "ein", "eine", "einen", "einem", "einer", "eines", "mein", "meine",
    "meinen", "meinem", "meiner", "unser", "unsere", "unserem", "dein", "sein", "seine", "ihr", "ihre", "the", "a",
    "an", "my", "our", "his", "her",
)
#: Names that are never entities of their own.
STOP_NAMES = (
    "the", "a", "an", "he", "she", "they", "it", "we", "i", "you", "this", "that", "these", "those", "today",
    "yesterday", "tomorrow", "mr", "mrs", "ms", "dr", "sir", "madam",
)
#: Endings of organisations' names.
ORG_ENDINGS = (
    "partei", "bewegung", "front", "bund", "gewerkschaft", "verband", "vereinigung", "verein", "gesellschaft", "loge",
    "orden", "regiment", "bataillon", "brigade", "korps", "kompanie", "standarte", "party", "movement", "league",
    "union", "association", "federation", "alliance", "brotherhood", "guild", "battalion", "corps",
)


def repair(text: Column) -> Column:
    """Undo the umlaut damage and drop zero-width characters."""
    fixed = reduce(lambda c, kv: F.replace(c, F.lit(kv[0]), F.lit(kv[1])), MOJIBAKE.items(), text)
    return F.translate(fixed, ZERO_WIDTH, "")


def clean_surface(text: Column) -> Column:
    return F.trim(F.regexp_replace(repair(text), r"(?U)\s+", " "))


def name_key(name: Column) -> Column:
    """The key that names are grouped by: repaired, without punctuation but & . -, spaces single, lower case."""
    bare = F.regexp_replace(F.trim(repair(name)), r"(?U)[^\w\s&.-]", "")
    return F.lower(F.trim(F.regexp_replace(bare, r"(?U)\s+", " ")))


def normalize_text(text: Column) -> Column:
    """Line ends and blanks in order: lines without trailing space, at most two blank lines in a row."""
    lines = F.replace(F.replace(repair(text), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    lines = F.replace(lines, F.lit("\u00a0"), F.lit(" "))
    lines = F.regexp_replace(lines, r"[ \t\f\x0B]+(?=\n|$)", "")
    return F.regexp_replace(F.regexp_replace(lines, r"\n{4,}", "\n\n\n"), r"^\s+|\s+$", "")


def cut_reference_tail(text: Column) -> Column:
    """Without the part from the first reference heading in the back half on, if at least half stays; texts of
    under ten lines stay as they are."""
    lines = F.split(text, "\n")
    n = F.size(lines)
    heading = lambda ln: F.lower(F.trim(F.rtrim(F.regexp_replace(F.trim(ln), r"^#+|:+$", ""))))
    back = F.slice(lines, F.floor(n / 2).cast("int") + 1, n)
    at = F.array_position(F.transform(back, lambda ln: heading(ln).isin(*REFERENCE_HEADINGS)), True)
    kept = F.trim(F.array_join(F.slice(lines, 1, (F.floor(n / 2) + at - 1).cast("int")), "\n"))
    good = (n >= 10) & (at > 0) & (F.length(kept) >= 0.5 * F.length(text))
    return F.when(good, kept).otherwise(text)


def _is_pattern(text: str) -> bool:
    try:
        re.compile(text)
    except re.error:
        return False
    return True


def strip_boilerplate(text: Column, patterns: list[str]) -> Column:
    """Each pattern to a space, runs of blanks to one; what is no pattern is ignored."""
    cut = reduce(lambda c, p: F.regexp_replace(c, p, " "), filter(_is_pattern, patterns), text)
    return F.trim(F.regexp_replace(cut, r"[ \t]{2,}", " "))


def stable_id(*parts: Column, prefix: str = "", length: int = 12) -> Column:
    return F.concat(F.lit(prefix), F.substring(F.sha1(F.concat_ws("||", *[p.cast("string") for p in parts])), 1, length))


def strip_determiner(key: Column) -> Column:
    tokens = F.split(key, " ")
    leads = (F.size(tokens) > 1) & F.element_at(tokens, 1).isin(*DETERMINERS)
    return F.when(leads, F.array_join(F.slice(tokens, 2, F.size(tokens)), " ")).otherwise(key)


def bad_name(name: Column) -> Column:
    """Too short, a stop name, or digits alone."""
    trimmed = F.trim(name)
    return (F.length(trimmed) < 2) | name_key(name).isin(*STOP_NAMES) | trimmed.rlike(r"^\d+$")


def junk_person(name: Column) -> Column:
    """A single token of up to three characters, or no capital."""
    key = name_key(name)
    return (~key.contains(" ") & (F.length(key) <= 3)) | ~name.rlike(r"\p{Lu}")


def org_marker(name: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(name)), r"\.+$", "").rlike("(" + "|".join(ORG_ENDINGS) + ")$")


def fold_evidence(text: Column) -> Column:
    """For verbatim checks: lower case, punctuation gone, blanks single."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\s]", ""), r"\s+", " "))


def verbatim(evidence: Column, text: Column, least: int = 8) -> Column:
    """Every segment (between ellipses) of at least ``least`` characters occurs in the text."""
    segments = F.transform(F.split(F.replace(evidence, F.lit("…"), F.lit("...")), r"\.\.\."), fold_evidence)
    return F.forall(F.filter(segments, lambda s: F.length(s) >= least), lambda s: F.contains(fold_evidence(text), s))


def acronym(name: Column) -> Column:
    """Initials of the capitalised words."""
    words = F.filter(F.split(name, r"\s+"), lambda w: w.rlike(r"^\p{Lu}"))
    return F.array_join(F.transform(words, lambda w: F.substring(w, 1, 1)), "")


def numeric_alias(alias: Column) -> Column:
    digits = F.length(F.regexp_replace(alias, r"\D", ""))
    return (digits >= 3) | (digits > 0.4 * F.length(alias))


def handles(text: Column) -> Column:
    """Distinct handles after @ or u/, in order."""
    found = F.regexp_extract_all(text, F.lit(r"(?:^|[^\w/])(?:@|/?u/)([A-Za-z0-9_-]{2,})"), F.lit(1))
    return F.array_distinct(found)

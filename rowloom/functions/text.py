"""Column expressions that clean and normalise text."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[ \t\n\x0B\f\r]+"


@lru_cache(maxsize=1)
def accent_table() -> tuple[str, str]:
    """Accented Latin letters and their bases, derived from the Unicode decompositions."""
    source, base = [], []
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        char = chr(code)
        bare = "".join(c for c in unicodedata.normalize("NFD", char) if unicodedata.category(c) != "Mn")
        if bare != char and len(bare) == 1:
            source.append(char)
            base.append(bare)
    return "".join(source), "".join(base)


def strip_accents(col: Column) -> Column:
    """Latin letters without accents; combining marks are removed."""
    source, base = accent_table()
    return F.regexp_replace(F.translate(col, source, base), r"\p{Mn}+", "")


def collapse_space(col: Column) -> Column:
    """White space runs become one blank, ends are trimmed; null stays null."""
    return F.trim(F.regexp_replace(col, SPACE, " "))


def repair_encoding(col: Column) -> Column:
    """UTF-8 that was read as Latin-1 is read again; text that is not such stays as it is."""
    again = F.try_validate_utf8(F.encode(col, "ISO-8859-1").cast("string"))
    broken = col.rlike("[Â-ô][\u0080-¿]") & ~col.rlike("[^\u0000-ÿ]")
    return F.when(broken, F.coalesce(again, col)).otherwise(col)


# Words that stand for a missing value.
NULL_WORDS = ["nan", "none", "null", "nat"]
# Words that carry no meaning in titles of degrees and jobs.
STOPWORDS = [
    "grado", "master", "máster", "en", "de", "la", "el", "los", "las", "y", "del", "un", "una", "programa",
    "formacion", "formación", "general", "tecnico", "tecnicos", "tecnica", "tecnicas", "apoyo", "asistencia",
]
# Words left out of the tokens of a title when links are compared with it.
TITLE_STOPWORDS = ["grado", "master", "doctorado", "universitario", "oficial", "titulo"]


def clean_text(col: Column) -> Column:
    """Tags become blanks, white space collapses; blank text and null words become null."""
    text = collapse_space(F.regexp_replace(col.cast("string"), r"<[^>]+>", " "))
    return F.when((text == "") | F.lower(F.trim(col.cast("string"))).isin(NULL_WORDS), None).otherwise(text)


def norm_words(col: Column) -> Column:
    """Lower case, no accents, anything but letters and digits becomes one blank."""
    return F.trim(F.regexp_replace(strip_accents(F.lower(col)), r"[^a-z0-9]+", " "))


def norm_ascii(col: Column) -> Column:
    """Like ``norm_words``, but a letter without an ASCII base is dropped, not spaced."""
    ascii_only = F.regexp_replace(strip_accents(col), r"[^\x00-\x7F]+", "")
    return F.trim(F.regexp_replace(F.lower(ascii_only), r"[^a-z0-9]+", " "))


def norm_match(col: Column) -> Column:
    """Lower case, no accents, white space collapsed; punctuation stays.  Null becomes empty."""
    return F.coalesce(collapse_space(strip_accents(F.lower(col))), F.lit(""))


def tokens(norm: Column) -> Column:
    """Words of a normalised text without stopwords, in order, repetitions kept."""
    return F.filter(F.split(norm, " "), lambda w: (w != "") & ~w.isin(STOPWORDS))


def title_tokens(col: Column) -> Column:
    """Lower-case words of four letters or more of a title, without words that every title has."""
    words = F.split(F.regexp_replace(F.lower(col), r"[^\p{L}\p{N}]+", " "), " ")
    return F.filter(words, lambda w: (F.length(w) > 3) & ~w.isin(TITLE_STOPWORDS))


def token_key(token: Column) -> Column:
    """Two tokens match if they are equal or share five leading letters; that is equality of this key."""
    return F.substring(token, 1, 5)


def pipe_values(col: Column) -> Column:
    """Distinct trimmed non-empty parts of a pipe list; null gives an empty array."""
    parts = F.transform(F.split(F.coalesce(col, F.lit("")), r"\|"), lambda p: F.trim(p))
    return F.array_distinct(F.filter(parts, lambda p: p != ""))


def pipe_join(values: Column) -> Column:
    """Distinct non-empty values as a pipe list; null if there is none."""
    kept = F.array_distinct(F.filter(values, lambda v: v.isNotNull() & (v != "")))
    return F.nullif(F.array_join(kept, "|"), F.lit(""))


def chunks(col: Column, size: int = 3000) -> Column:
    """Fixed slices of the collapsed text, an empty array for empty text."""
    text = F.coalesce(collapse_space(col), F.lit(""))
    starts = F.sequence(F.lit(0), F.greatest(F.length(text) - 1, F.lit(0)), F.lit(size))
    return F.when(text == "", F.array().cast("array<string>")).otherwise(
        F.transform(starts, lambda at: F.substring(text, at + 1, F.lit(size)))
    )


def text_hash(col: Column) -> Column:
    """SHA-256 of the text with collapsed white space."""
    return F.sha2(collapse_space(F.coalesce(col, F.lit(""))), 256)


def cache_key(provider: Column, model: Column, hashed: Column) -> Column:
    return F.sha2(F.concat_ws(":", provider, model, hashed), 256)


def estimated_tokens(col: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(F.length(F.coalesce(col, F.lit(""))) / 4)).cast("bigint")


def plain_description(col: Column, most: int = 10_000) -> Column:
    """A posting's description without label lines, headings and asterisks, cut with an ellipsis."""
    # Labels of the lines to drop and headings to drop.
    labels = "Location|Salary|Company|Posted|Job type|Contract type|Schedule|Experience|Benefits|Source"
    headings = "Job description|Full job description|Descripción del puesto"
    text = F.regexp_replace(col, rf"(?im)^\s*\**(?:{labels})\**\s*:.*$", " ")
    text = F.regexp_replace(text, rf"(?im)^\s*[#*]*\s*(?:{headings})\s*:?\**\s*$", " ")
    text = F.nullif(collapse_space(F.regexp_replace(text, r"\*+", " ")), F.lit(""))
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit("..."))).otherwise(text)


def report_section(col: Column, most: int = 4000) -> Column:
    """The text between the motivation and the recommendations of a report, else all of it."""
    between = F.regexp_extract(col, r"(?is)MOTIVACI[OÓ]N(.*?)(?:RECOMENDACIONES|En Madrid, a)", 1)
    return F.nullif(F.substring(collapse_space(F.coalesce(F.nullif(between, F.lit("")), col)), 1, most), F.lit(""))


def degree_title(col: Column) -> Column:
    """A doubled prefix such as "Grado en Grado en" becomes one."""
    text = collapse_space(col)
    for prefix in ("Grado", "M[aá]ster Universitario", "M[aá]ster", "Doctorado", "Programa de Doctorado"):
        text = F.regexp_replace(text, rf"(?i)^({prefix}) en (?:{prefix}) en ", "$1 en ")
    return text


def program_title(col: Column) -> Column:
    """A programme's label without novelty marks; double degrees get one form; 250 characters at most."""
    text = F.trim(F.replace(collapse_space(F.coalesce(col, F.lit(""))), F.lit("Nuevo/New"), F.lit("")))
    # Novelty marks, in the order in which they are removed.
    for mark in (r"Nuevo en 2026/2027", r"Nuevo en 2026", r"Plan nuevo \(2026\)", r"Plan nuevo", r"Nuevo"):
        text = F.trim(F.regexp_replace(text, rf"{mark}$", ""))
    double = F.regexp_replace(text, r"(?iu)^doble titulación:\s*(?:grado en )?\s*(.*)$", "Doble Grado en $1")
    text = F.when(F.lower(text).startswith("doble titulación:"), double).otherwise(text)
    return F.when(text == "", F.lit("Unknown title")).otherwise(F.substring(text, 1, 250))


def title_from_slug(url: Column) -> Column:
    """The last part of an address as a title."""
    return F.initcap(F.replace(F.regexp_extract(url, r"([^/]+)/?$", 1), F.lit("-"), F.lit(" ")))


def mentions(norm: Column, keywords: list[str]) -> Column:
    """Whether any keyword is a substring of a normalised text."""
    out = F.lit(False)
    for word in keywords:
        out = out | norm.contains(word)
    return out & (norm != "")

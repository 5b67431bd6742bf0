"""Template residue, filler, error pages and script notices in place of content.

Two kinds of evidence are combined.  Detectors look for placeholders and for the wording of
filler, errors and notices.  Host evidence looks for what no detector knows: one body, but for
numbers and identifiers, that a host serves for several titles, that shares no term with the
title or the address slug, and whose terms are not those of the host's other texts.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.functions.text import strip_accents
from rowloom.operators.joins import is_small
from rowloom.session import cut_lineage

# Placeholder syntaxes of common template languages.
PLACEHOLDERS = [
    r"\{\{[^{}]*\}\}", r"\{%[^{}]*%\}", r"<%[^<>]*%>", r"<<[^<>]+>>", r"\[\[[^\[\]]+\]\]", r"[$#@%]\{[^{}]+\}",
    r"\{[\p{L}_][\p{L}\d_. ]*\}", r"%\([\p{L}\d_. ]+\)[sd]", r"(?<![\p{L}\d])%[\p{L}_][\p{L}\d_.]*%",
    r"(?<![\p{L}\d])__[\p{L}][\p{L}\d_.]*__", r"@@[\p{L}\d_.]+@@",
    r"<(?!/?(?:b|i|u|p|br|em|strong|ul|ol|li|h[1-6]|div|span|a|td|tr|th|table|img|hr)\b)[\p{L}_][\p{L}\d_. -]*>",
    r"\[(?i:insertar|insert|inserte|t[íi]tulo|rellenar|completar|pendiente|your|su|tu|nombre)\b[^\[\]]*\]",
    r"\[[\p{Ll}_]+(?:\.[\p{Ll}_]+)*\]", r"\[[\p{Lu}_]{4,}(?:\.[\p{Lu}_]+)*\]", r"\[object Object\]", r"\?\?\?",
    r"\{\d*\}", r"(?<![\p{L}\d])%[sd](?![\p{L}\d])", r"_{4,}", r"\[\.\.\.[\p{L} ]+\.\.\.\]",
]
#: No placeholder begins with another sign, so most positions are passed over at once.
SIGNS = r"(?=[{<\[%$#@_?])"
#: A note to the author; in text that is all upper case it is the ordinary Spanish word.
TODO = r"(?:^|[\p{Ll}:,(] )(?:TODO(?:$|[ .:,;)](?!\p{Lu}{2}))|undefined(?![\p{L}\d]))"

# Wording of filler and test text; texts are lower case.
_MASH = "asdf|qwerty|xxx|bla|abc|test|prueba|foo|bar"
_LOREM = (
    "lorem|ipsum|dolor|sit|amet|consectetur|adipiscing|elit|sed|do|eiusmod|tempor|incididunt|ut|labore|et|dolore"
    "|magna|aliqua|enim|ad|minim|veniam|quis|nostrud|ullamco|laboris|nisi|aliquip|ex|ea|commodo"
)
FILLER = [
    r"lorem ipsum", rf"(?:{_LOREM})\b[ ,.]*(?:(?:{_LOREM})\b[ ,.]*){{4}}", rf"(?:{_MASH})\b(?:[ ,.]+(?:{_MASH})\b)+", r"asdf\b", r"qwerty\b",
    r"(?:texto|contenido|descripci[oó]n|t[ií]tulo) (?:de (?:prueba|ejemplo|relleno)|provisional|pendiente)",
    r"borrador sin ", r"your text here", r"(?:sample|dummy|placeholder) (?:description|text|title|content)",
    r"insert [a-z ]{1,40}here", r"aqu[ií] va (?:la|el|una?) ",
    r"escrib[ae] (?:aqu[ií]|en este espacio|el t[ií]tulo|la descripci|su texto)",
    r"t[ií]tulo (?:del puesto |de la oferta )?aqu[ií]", r"untitled(?: document)?\b", r"nueva oferta \(plantilla\)",
    r"no publicar\b", r"sin t[ií]tulo\b",
]

# Wording of errors of sites and programs.
ERRORS = [
    r"http(?:/[\d.]+)? [45]\d\d\b", r"error [45]\d\d\b ?[-:–(]",
    r"[45]\d\d (?:not found|forbidden|unauthorized|bad gateway|service|internal|gone|too many|gateway|p[aá]gina|error|acceso|demasiad|servicio|la oferta)",
    r"(?:4\d\d|50\d)\)\. ", r"h1>[45]\d\d</h1", r"p[aá]gina no encontrada", r"page not found", r"not found \(",
    r"error interno del servidor", r"internal server error", r"bad gateway", r"service unavailable", r"gateway time-?out",
    r"acceso denegado", r"access denied", r"demasiadas peticiones", r"too many requests",
    r"servicio no disponible", r"oferta ya no est[aá] disponible en esta direcci", r"p[aá]gina que (?:buscas?|busca usted) ",
    r"something went wrong", r"algo ha salido mal", r"requested (?:resource|url|page) (?:could|was) not",
    r"sitio en mantenimiento", r"site (?:is )?under maintenance", r"sesi[oó]n (?:ha )?caducad", r"session (?:has )?expired",
    r"identificarse para ver", r"si el problema contin[uú]a", r"int[eé]ntelo m[aá]s tarde", r"try again in a few minutes",
    r"traceback \(most recent", r"fatal error: ", r"uncaught (?:type|reference|range)?error",
    r"(?:java|javax|org|com)\.[\w.]+(?:exception|error)\b", r"nullpointerexception",
    r"sqlstate\[", r"undefined (?:index|variable|offset|property|function)", r"stack trace:", r"unhandled exception", r"keyerror: ",
]

# Wording of notices that ask for scripts, cookies or a human check.
NOTICES = [
    r"activ[ae] (?:el )?javascript", r"enable javascript", r"habilit[ae] (?:los scripts|javascript)", r"ejecuci[oó]n de scripts",
    r"allow scripts", r"scripts switched on", r"turn on (?:scripting|javascript|cookies)", r"secuencias de comandos",
    r"navegador con javascript", r"javascript (?:is )?(?:disabled|required|desactivado)",
    r"usamos cookies", r"utilizamos cookies", r"acept[ae] (?:las |todas las )?cookies", r"we use cookies", r"accept (?:all )?cookies",
    r"aceptar todo ?[·|-] ?rechazar", r"configure su consentimiento", r"no eres un robot", r"not a robot", r"verifi(?:ca|que) que (?:eres|es) ",
    r"verify (?:that )?you are (?:a )?human", r"checking your browser", r"just a moment", r"un momento, por favor",
    r"complet[ae] el captcha", r"captcha",
]

#: Words that are only evidence together with a body that has nothing to do with its title.
WEAK = r"\b(?:errors?|servidor|server|navegador|browser|cookies?|scripts?|sesion|session|recargu?e|reload|scripting|pagina|page|click here)\b"

#: A body of so few characters holds little information; with weak words it is no content.
SHORT = 240
#: A body under so many titles of a host is a response of the host; a term that so large a share of
#: the host's other texts has is a term of its real texts, and a response has fewer than half of those.
TITLES, KNOWN, STRANGE = 2, 0.02, 0.5


def any_of(patterns: list[str]) -> str:
    """One pattern for many: a tree by their letters, so that a word is compared once with what many begin with.

    No pattern has alternatives outside of groups.  What all begin with is looked at first."""
    starts = {x[:1] for p in patterns for x in _heads(p)}
    known = all(re.fullmatch(r"[^\W_]", c) for c in starts)
    return r"\b" + (f"(?=[{''.join(sorted(starts))}])" if known else "") + _tree(patterns)


def _heads(pattern: str) -> list[str]:
    """The pattern once for each alternative of the group, or letter of the class, that it begins with."""
    if group := re.match(r"\(\?:((?:[^()\[\]\\]|\\.|\[[^\]|]*\])*)\)(?![?*+{])", pattern):
        return [x for part in group[1].split("|") for x in _heads(part + pattern[group.end() :])]
    if letters := re.match(r"\[([^\W_]+)\](?![?*+{])", pattern):
        return [c + pattern[letters.end() :] for c in letters[1]]
    return [pattern]


def _tree(patterns: list[str]) -> str:
    """The patterns grouped by first letter or blank, again and again."""
    patterns = [x for p in patterns for x in _heads(p)]
    if "" in patterns:
        return ""
    letters: dict[str, list[str]] = {}
    others: list[str] = []
    for p in patterns:
        if re.match(r"(?: |[^\W_])(?![?*+{])", p):
            letters.setdefault(p[0], []).append(p[1:])
        else:
            others.append(p)
    parts = [c + _tree(rest) for c, rest in letters.items()] + list(dict.fromkeys(others))
    return parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"


def detectors(value: Column, low: Column) -> Column:
    """The name of the first detector that finds something, null if none does."""
    named = (
        F.when(low.rlike(any_of(NOTICES)), "notice").when(low.rlike(any_of(ERRORS)), "error").otherwise("filler")
    )
    todo = (value.contains("TODO") | value.contains("undefined")) & value.rlike(TODO)
    return (
        F.when(value.rlike(SIGNS + "(?:" + "|".join(PLACEHOLDERS) + ")"), "placeholder")
        .when(low.rlike(any_of([*NOTICES, *ERRORS, *FILLER])), named)
        .when(todo, "placeholder")
    )


def terms(text: Column) -> Column:
    """Distinct words of three letters or more."""
    return F.array_distinct(F.filter(F.split(text, r"[^\p{L}]+"), lambda w: F.length(w) >= 3))


def find_residue(df: DataFrame, id_col: str, fields: list[str], title: str, url: str, only: DataFrame | None = None) -> DataFrame:
    """Rows ``(id, field, reason)`` of the values that hold something else than content.

    ``reason`` is the detector, ``weak`` where neither title nor slug shares a term with a short
    body of at least two weak words, or ``host`` where only host evidence speaks.  ``only`` are the
    ids that are asked about; the evidence of the hosts comes from all rows all the same.

    * Null values are no cases, nor is empty text.
    * A null title or address shares no term; rows without address are compared per table.
    * Very long texts are searched whole.  Repeated rows are kept; an empty table gives none.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in fields])
    host = F.coalesce(F.regexp_extract(F.col(url), r"^[a-z]+://([^/?#]+)", 1), F.lit(""))
    slug = F.regexp_replace(F.coalesce(F.col(url), F.lit("")), r"^[a-z]+://[^/?#]+", " ")
    base = df.select(F.col(id_col).alias("__id"), host.alias("host"), slug.alias("slug"), F.col(title).alias("title"), F.explode(cells).alias("c"))
    base = base.select("__id", "host", "slug", "title", "c.*").where(F.length(F.trim("value")) > 0)
    rows = base if only is None else base.join(only.select(F.col(id_col).alias("__id")).distinct(), "__id", "left_semi")
    rows = rows.select("*", F.explode(F.array(F.lower("value"))).alias("low"))
    rows = rows.select("*", F.explode(F.array(detectors(F.col("value"), F.col("low")))).alias("reason"))

    # The texts are searched once; what is kept are the findings and the short bodies.
    body = F.col("field") != title
    rows = rows.where(F.col("reason").isNotNull() | (body & (F.length("value") <= SHORT)))
    text = F.when(F.col("reason").isNull(), strip_accents(F.col("low")))
    rows = cut_lineage(rows.select("__id", "slug", "title", "field", "reason", text.alias("plain")))

    context = terms(strip_accents(F.lower(F.concat_ws(" ", "title", "slug"))))
    short = rows.where(F.col("reason").isNull()).withColumn("words", terms(F.col("plain")))
    weak_words = F.array_distinct(F.regexp_extract_all("plain", F.lit(f"({WEAK})"), F.lit(1)))
    weak = short.where(~F.arrays_overlap("words", context) & (F.size(weak_words) >= 2) & (F.size("words") < 12 * F.size(weak_words)))
    found = rows.where(F.col("reason").isNotNull()).select("__id", "field", "reason")
    found = found.unionByName(weak.select("__id", "field", F.lit("weak").alias("reason")))
    found = cut_lineage(found)
    asked = base.where(body) if only is None else base.where(body).join(only.select(F.col(id_col).alias("__id")).distinct(), "__id", "left_semi")
    found = found.unionByName(host_evidence(base.where(body), asked, found))
    rank = F.when(F.col("reason") == "host", 1).otherwise(0)
    return found.groupBy("__id", "field").agg(F.min(F.struct(rank.alias("rank"), "reason")).alias("r")).select(
        F.col("__id").alias(id_col), "field", "r.reason"
    )


def host_evidence(bodies: DataFrame, asked: DataFrame, found: DataFrame) -> DataFrame:
    """``(__id, field, reason)`` of the ``asked`` bodies that their host serves under several titles and that
    use other words than its other texts.  Bodies of any length take part; what is ``found`` already
    needs no more evidence."""
    key = ["host", "field", "print"]
    # Digits and the letters of hexadecimal identifiers are left out, so one message is one fingerprint.
    mark = F.xxhash64(F.translate(F.lower(F.col("value")), "0123456789abcdef", ""))
    plain = terms(strip_accents(F.lower(F.col("value"))))
    context = terms(strip_accents(F.lower(F.concat_ws(" ", "title", "slug"))))
    marked = bodies.select("host", "field", mark.alias("print"), F.lower(F.coalesce("title", F.lit(""))).alias("title"))
    titles = marked.distinct().groupBy(*key).agg(F.count("*").alias("titles"))
    served = cut_lineage(titles.where(F.col("titles") >= TITLES).select(*key))
    nothing = found.select("__id", "field", F.lit("host").alias("reason")).limit(0)
    rows = asked.withColumn("print", mark).join(served, key, "left_semi").join(found, ["__id", "field"], "left_anti")
    rows = cut_lineage(rows.select("__id", *key, "title", "slug", "value"))
    if rows.isEmpty():
        return nothing

    # The words of one copy stand for all; every row is compared with its own title and slug.
    words = rows.groupBy(*key).agg(F.first("value").alias("value")).select(*key, F.explode(F.array(plain)).alias("words"))
    words = cut_lineage(words.where(F.size("words") > 0))
    strange = rows.select("__id", *key, context.alias("context")).join(words, key).where(~F.arrays_overlap("words", "context"))
    strange = cut_lineage(strange.select("__id", *key))

    # A term that several served texts of a host have is a term of the host.
    single = words.select(*key, F.size("words").alias("size"), F.explode("words").alias("word"))
    shared = single.groupBy("host", "field", "word").agg(F.count("*").alias("n")).where("n > 1").select("host", "field", "word", F.lit(1).alias("known"))
    open_ = _unknown(single.join(strange.select(*key).distinct(), key, "left_semi"), shared)
    open_ = cut_lineage(open_)
    if open_.isEmpty():
        return nothing

    # What is left is looked up in all other texts of its hosts.
    left = cut_lineage(single.join(open_, key, "left_semi"))
    hosts = open_.select("host", "field").distinct()
    rich = bodies.join(hosts, ["host", "field"], "left_semi").withColumn("print", mark).join(open_, key, "left_anti")
    totals = rich.groupBy("host", "field").agg(F.count("*").alias("n"))
    wanted = left.select("host", "field", "word").distinct()
    vocabulary = rich.select("host", "field", F.explode(plain).alias("word"))
    vocabulary = vocabulary.join(F.broadcast(wanted) if is_small(wanted) else wanted, ["host", "field", "word"], "left_semi")
    vocabulary = vocabulary.groupBy("host", "field", "word").agg(F.count("*").alias("df")).join(totals, ["host", "field"])
    vocabulary = vocabulary.where(F.col("df") >= KNOWN * F.col("n")).select("host", "field", "word", F.lit(1).alias("known"))
    return strange.join(_unknown(left, vocabulary), key, "left_semi").select("__id", "field", F.lit("host").alias("reason"))


def _unknown(words: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """The texts of ``(host, field, print, size, word)`` of whose words too few are in the vocabulary."""
    known = words.join(vocabulary, ["host", "field", "word"], "left").groupBy("host", "field", "print")
    share = known.agg((F.coalesce(F.sum("known"), F.lit(0)) / F.max("size")).alias("share"))
    return share.where(F.col("share") < STRANGE).select("host", "field", "print")

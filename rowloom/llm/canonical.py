"""Free-typed values mapped to the closest entry of a reference list.

A prefix-filter set-similarity join: every text becomes a set of letters, letter pairs and
pairs across one letter; tokens are ordered by global rarity; two sets can only reach the
threshold if their prefixes of rarest tokens meet, so only those are joined.  Length and
positional filters drop most meetings, the rest is verified by the exact Jaccard value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.functions.text import repair_encoding, strip_accents
from rowloom.operators.joins import is_small
from rowloom.session import cut_lineage

# Abbreviations, little words and words that name only the kind of the value.
ABBREVIATIONS = {
    "pto": "puerto", "vlle": "valle", "v": "villa", "bco": "barranco", "sta": "santa", "sto": "santo", "s": "san",
    "ntra": "nuestra", "sra": "senora", "gral": "general",
}
LITTLE_WORDS = ["", "de", "del", "dela", "dla", "dl", "d", "la", "las", "el", "los", "lo", "y", "of", "the"]
KIND_WORDS = {
    "municipality": ["ayto", "ayuntamiento", "termino", "municipal", "municipio", "tm", "localidad", "ciudad"],
    "province": ["provincia", "prov", "province"],
    "contract_type": ["contrato", "contract", "tipo", "laboral"],
}
#: Segments of a place that are an address line.
STREET = r"^(?:c|calle|avda|av|avenida|plaza|pza|poligono|pol|ctra|carretera|camino|nave|local|planta|no)\b"

THRESHOLD = 0.5


def normal_words(text: Column, kind: Column, drop_kind_words: bool = True) -> Column:
    """Lower case words without accents, digits, little words and words of the kind, joined by blanks."""
    words = F.split(F.regexp_replace(F.regexp_replace(text, r"[^a-z]+", " "), r"\bt m\b", "tm"), " ")
    full = F.create_map(*[F.lit(x) for pair in ABBREVIATIONS.items() for x in pair])
    words = F.transform(words, lambda w: F.coalesce(F.element_at(full, w), w))
    words = F.filter(words, lambda w: ~w.isin(LITTLE_WORDS))
    if drop_kind_words:
        named = F.create_map(*[x for k, ws in KIND_WORDS.items() for x in (F.lit(k), F.array(*map(F.lit, ws)))])
        words = F.array_except(words, F.coalesce(F.element_at(named, kind), F.array().cast("array<string>")))
    return F.array_join(words, " ")


def plain(text: Column) -> Column:
    t = strip_accents(F.lower(repair_encoding(text)))
    return F.regexp_replace(t, r"\bs ?/ ?c\b|\bs\. ?c\.", "santa cruz")


def segments(values: DataFrame) -> DataFrame:
    """``(kind, value)`` to ``(kind, value, seg, part)``: the parts of a value that may name an entry."""
    t = plain(F.col("value"))
    t = F.regexp_replace(t, r"\b(?:c|calle)/", "calle ")
    parts = F.split(t, r"[,/>()\[\]+;|]|[ ]-[ ]")
    rows = values.select("kind", "value", F.posexplode(parts).alias("seg", "part"))
    part = F.trim(F.regexp_replace(F.col("part"), r"\b\d{5}\b", " "))
    rows = rows.where(~((F.col("kind") == "municipality") & part.rlike(STREET)))
    return rows.select("kind", "value", "seg", normal_words(part, F.col("kind")).alias("part")).where("part <> ''")


def spans(rows: DataFrame, longest: int) -> DataFrame:
    """Contract types are often the first words of a phrase: all runs of up to ``longest`` words."""
    words = F.split("part", " ")
    at = F.sequence(F.lit(1), F.size(words))
    all_spans = F.flatten(
        F.transform(
            at,
            lambda i: F.transform(
                F.sequence(F.lit(1), F.least(F.lit(longest), F.size(words) - i + 1)),
                lambda n: F.struct(i.alias("start"), F.array_join(F.slice(words, i, n), " ").alias("span")),
            ),
        )
    )
    whole = F.array(F.struct(F.lit(1).alias("start"), F.col("part").alias("span")))
    wanted = F.when(F.col("kind") == "contract_type", all_spans).otherwise(whole)
    return rows.select("kind", "value", "seg", F.explode(wanted).alias("s")).select("kind", "value", "seg", "s.*")


def token_set(text: Column) -> Column:
    """Distinct tokens of a text; a token that occurs again carries its number, as sets must."""
    grams = F.flatten(
        F.transform(
            F.split(text, " "),
            lambda w: F.flatten(
                F.transform(
                    F.sequence(F.lit(1), F.length(w) + 1),
                    lambda i: F.filter(
                        F.array(
                            F.substring(F.concat(F.lit("_"), w, F.lit("_")), i, 2),
                            F.when(i <= F.length(w), F.substring(w, i, 1)),
                            F.when(
                                i <= F.length(w),
                                F.concat(
                                    F.substring(F.concat(F.lit("_"), w, F.lit("_")), i, 1),
                                    F.substring(F.concat(F.lit("_"), w, F.lit("_")), i + 2, 1),
                                ),
                            ),
                        ),
                        lambda g: g.isNotNull(),
                    ),
                )
            ),
        )
    )
    return grams


def token_rows(texts: DataFrame) -> DataFrame:
    """``(kind, text)`` to ``(kind, text, token)`` with repeated tokens numbered."""
    rows = texts.select("kind", "text", F.explode(token_set(F.col("text"))).alias("gram"))
    counted = rows.groupBy("kind", "text", "gram").agg(F.count("*").cast("int").alias("n"))
    numbered = F.explode(F.sequence(F.lit(1), F.col("n"))).alias("k")
    return counted.select("kind", "text", "gram", numbered).select(
        "kind", "text", F.concat_ws("#", "gram", F.when(F.col("k") > 1, F.col("k").cast("string"))).alias("token")
    )


def ordered_sets(texts: DataFrame, rarity: DataFrame) -> DataFrame:
    """``(kind, text, tokens)`` with the tokens in global order, rarest first."""
    rows = token_rows(texts)
    rarity = F.broadcast(rarity) if is_small(rarity) else rarity
    rows = rows.join(rarity, "token")
    pairs = F.array_sort(F.collect_list(F.struct("df", "token")))
    return rows.groupBy("kind", "text").agg(pairs.alias("p")).select("kind", "text", F.col("p.token").alias("tokens"))


def similarity_join(texts: DataFrame, entries: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows ``(kind, text, canon_id, sim)``: for each text of ``(kind, text)`` every entry of
    ``(kind, text, canon_id)`` of the same kind whose token sets have Jaccard >= ``threshold``.

    The size of neither side is bounded by the method: a small list of entries is broadcast,
    a larger one is joined by shuffle on (kind, token).
    """
    texts, entries = cut_lineage(texts.select("kind", "text").distinct()), cut_lineage(entries)
    both = texts.unionByName(entries.select("kind", "text")).distinct()
    rarity = cut_lineage(token_rows(both).groupBy("token").agg(F.count("*").alias("df")))
    left = ordered_sets(texts, rarity)
    forms = cut_lineage(ordered_sets(entries.select("kind", "text").distinct(), rarity))

    def prefixes(sets: DataFrame, as_: str) -> DataFrame:
        size = F.size("tokens")
        keep = size - F.ceil(F.lit(threshold) * size - 1e-9).cast("int") + 1
        return sets.select(
            "kind", F.col("text").alias(f"{as_}_text"), F.col("tokens").alias(as_),
            F.posexplode(F.slice("tokens", F.lit(1), keep)).alias(f"{as_}_pos", "token"),
        )

    index = prefixes(forms, "s")
    # The check looks at rows and bytes: the index repeats the tokens of a form.
    if is_small(index, 200_000):
        index = F.broadcast(index)
    met = prefixes(left, "r").join(index, ["kind", "token"])
    n, m = F.size("r"), F.size("s")
    length_ok = (m >= n * threshold - 1e-9) & (n >= m * threshold - 1e-9)
    needed = F.lit(threshold / (1 + threshold)) * (n + m) - 1e-9
    position_ok = 1 + F.least(n - F.col("r_pos") - 1, m - F.col("s_pos") - 1) >= needed
    met = met.where(length_ok & position_ok)
    # A pair is kept at its first common prefix token only, so it is verified once.
    before = F.arrays_overlap(F.slice("r", F.lit(1), F.col("r_pos")), F.slice("s", F.lit(1), F.col("s_pos")))
    met = met.where(~F.coalesce(before, F.lit(False)))
    common = F.size(F.array_intersect("r", "s"))
    met = met.withColumn("sim", common / (n + m - common)).where(F.col("sim") >= threshold - 1e-9)
    pairs = met.select("kind", F.col("r_text").alias("text"), F.col("s_text").alias("form"), "sim")
    forms_of = entries.select("kind", F.col("text").alias("form"), "canon_id").distinct()
    forms_of = F.broadcast(forms_of) if is_small(forms_of) else forms_of
    return pairs.join(forms_of, ["kind", "form"]).select("kind", "text", "canon_id", "sim")


def reference_forms(canon: DataFrame) -> DataFrame:
    """``(kind, text, canon_id)``: normalised values and aliases; islands and provinces count as
    competitors of municipalities under the id 0."""
    forms = F.explode(F.split(F.concat_ws("|", "canon_value", F.nullif("aliases", F.lit(""))), r"\|"))
    own = canon.select("kind", "canon_id", forms.alias("form"))
    islands = canon.where("kind = 'municipality'").select(F.explode(F.array("island", "province")).alias("form"))
    provinces = own.where("kind = 'province'").select("form")
    others = islands.unionByName(provinces).where("form is not null").distinct()
    others = others.select(F.lit("municipality").alias("kind"), F.lit(0).cast("bigint").alias("canon_id"), "form")
    rows = own.unionByName(others).where(F.col("form").isNotNull())
    # With and without the words of the kind: a mistyped "contrato" is still in the text.
    texts = F.array(*[normal_words(plain(F.col("form")), F.col("kind"), drop) for drop in (True, False)])
    rows = rows.select("kind", "canon_id", F.explode(texts).alias("text")).where("text <> ''")
    return rows.distinct()


def best_entries(values: DataFrame, canon: DataFrame) -> DataFrame:
    """Rows ``(kind, value, canon_id, sim)`` of the distinct values that some entry is similar to.

    A place takes the most similar entry over its segments; a contract type the entry named
    first, and of entries that start at one word the one that covers more letters.  Ties go
    to the smaller id.  A segment that is rather an island or a province is no municipality.
    """
    wanted = values.select("kind", "value").where(F.col("value").isNotNull()).distinct()
    forms = cut_lineage(reference_forms(canon))
    # As many words as the longest form of a contract type has.
    longest = forms.where("kind = 'contract_type'").agg(F.max(F.size(F.split("text", " ")))).first()[0] or 1
    parts = cut_lineage(spans(segments(wanted), longest))
    texts = parts.select("kind", F.col("span").alias("text")).distinct()
    found = similarity_join(texts, forms).withColumnRenamed("text", "span")
    hits = parts.join(found, ["kind", "span"])
    first = F.when(F.col("kind") == "contract_type", F.struct((-F.col("seg")).alias("seg"), (-F.col("start")).alias("start")))
    covers = F.when(F.col("kind") == "contract_type", F.col("sim") * F.length("span")).otherwise(F.col("sim"))
    rank = F.struct(first.alias("first"), covers.alias("covers"), (-F.col("canon_id")).alias("id"), "sim")
    per_segment = hits.groupBy("kind", "value", "seg").agg(F.max(rank).alias("b")).where(F.col("b.id") < 0)
    best = per_segment.groupBy("kind", "value").agg(F.max("b").alias("b"))
    return best.select("kind", "value", (-F.col("b.id")).alias("canon_id"), F.col("b.sim").alias("sim"))


def map_to_canonical(df: DataFrame, id_col: str, fields: dict[str, str], canon: DataFrame) -> DataFrame:
    """Rows ``(id, field, value, canon_id, sim)`` for every non-null value of ``fields``
    (column name to kind) that is not already, byte for byte, a canonical value of its kind.

    ``canon_id`` is 0 and ``sim`` null where no entry is similar enough; empty text, blanks
    and signs are such values.  Values are matched once per distinct value, so the cost of
    matching does not grow with repetition.  Null values give no row; an empty table gives an
    empty result; repeated rows are kept; other columns of ``df`` are not read.
    """
    cells = F.explode(
        F.array(*[
            F.struct(F.lit(c).alias("field"), F.lit(kind).alias("kind"), F.col(c).alias("value"))
            for c, kind in fields.items()
        ])
    )
    rows = df.select(F.col(id_col).alias("__id"), cells.alias("c")).select("__id", "c.*")
    rows = rows.where(F.col("value").isNotNull())
    exact = canon.select("kind", F.col("canon_value").alias("value")).distinct()
    exact = F.broadcast(exact) if is_small(exact) else exact
    rows = rows.join(exact, ["kind", "value"], "left_anti")
    mapped = rows.join(best_entries(rows, canon), ["kind", "value"], "left")
    entry = F.coalesce("canon_id", F.lit(0)).cast("bigint").alias("canon_id")
    return mapped.select(F.col("__id").alias(id_col), "field", "value", entry, "sim")

"""Canonical places and contract types, each with how it was found."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowloom.functions.text import clean_text

# Municipality to (name, island, province).
MUNICIPALITIES = {
    "las palmas de gran canaria": ("Las Palmas de Gran Canaria", "Gran Canaria", "Las Palmas"),
    "las palmas de g.c.": ("Las Palmas de Gran Canaria", "Gran Canaria", "Las Palmas"),
    "santa cruz de tenerife": ("Santa Cruz de Tenerife", "Tenerife", "Santa Cruz de Tenerife"),
    "san cristobal de la laguna": ("San Cristobal de La Laguna", "Tenerife", "Santa Cruz de Tenerife"),
    "san cristóbal de la laguna": ("San Cristobal de La Laguna", "Tenerife", "Santa Cruz de Tenerife"),
    "arrecife": ("Arrecife", "Lanzarote", "Las Palmas"),
    "puerto del rosario": ("Puerto del Rosario", "Fuerteventura", "Las Palmas"),
}
# Islands and the province each belongs to.
ISLANDS = {
    "Tenerife": "Santa Cruz de Tenerife", "Gran Canaria": "Las Palmas", "Lanzarote": "Las Palmas",
    "Fuerteventura": "Las Palmas", "La Palma": "Santa Cruz de Tenerife", "La Gomera": "Santa Cruz de Tenerife",
    "El Hierro": "Santa Cruz de Tenerife",
}
# Contract types and their exact names.
CONTRACTS = {
    "indefinido": ["indefinido", "contrato indefinido", "fijo", "permanent", "full time permanent"],
    "temporal": ["temporal", "contrato temporal", "eventual", "duracion determinada"],
    "formacion": ["formacion", "practicas", "beca", "internship", "aprendizaje"],
    "fijo_discontinuo": ["fijo discontinuo", "fijo-discontinuo"],
    "autonomo": ["autonomo", "freelance", "contract", "contratista"],
}
# Parts of words that tell a contract type, in the order in which they are tried.
CONTRACT_PARTS = {
    "indefinido": "indefin", "temporal": "tempor|sustit", "formacion": "practi|beca|intern", "autonomo": "autonom|freelance",
}


def _lookup(pairs: dict[str, str], key: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv]), key)


def province_of(island: Column) -> Column:
    """The province of an island, in any letter case; null for other names."""
    return _lookup({k.upper(): v for k, v in ISLANDS.items()}, F.upper(island))


def place(province: Column, municipality: Column, island: Column, raw_location: Column, cleaned: bool = False) -> Column:
    """A struct ``(province, municipality, island, raw_location, confidence)``.

    The municipality decides, else the island, else the province, else a raw location that is
    a municipality; what is missing stays null.  ``cleaned`` says that the text is clean already."""
    p, m, i, r = (c if cleaned else clean_text(c) for c in (province, municipality, island, raw_location))

    def listed(key: Column, k: int) -> Column:
        return _lookup({name: v[k] for name, v in MUNICIPALITIES.items()}, F.lower(key))

    def made(a: Column, b: Column, c: Column, how: str | Column) -> Column:
        how = F.lit(how) if isinstance(how, str) else how
        return F.struct(
            a.alias("province"), b.alias("municipality"), c.alias("island"), r.alias("raw_location"), how.alias("confidence")
        )

    canonical = F.coalesce(_lookup({k.lower(): k for k in ISLANDS}, F.lower(i)), i)
    provinces = {v.lower(): v for v in ISLANDS.values()}
    neither = F.when(r.isNotNull(), "unresolved").otherwise("missing")
    return (
        F.when(listed(m, 0).isNotNull(), made(listed(m, 2), listed(m, 0), listed(m, 1), "municipality_index"))
        .when(i.isNotNull(), made(F.coalesce(province_of(canonical), p), m, canonical, "island"))
        .when(p.isNotNull(), made(F.coalesce(_lookup(provinces, F.lower(p)), p), m, i, "province"))
        .when(listed(r, 0).isNotNull(), made(listed(r, 2), listed(r, 0), listed(r, 1), "raw_location_index"))
        .otherwise(made(p, m, i, neither))
    )


def contract(value: Column, cleaned: bool = False) -> Column:
    """A struct ``(contract_type, confidence)``: exact name, part of a word, else other."""
    text = F.coalesce(F.lower(value if cleaned else clean_text(value)), F.lit(""))

    def made(kind: str | None, how: str) -> Column:
        return F.struct(F.lit(kind).cast("string").alias("contract_type"), F.lit(how).alias("confidence"))

    out = F.when(text == "", made(None, "missing"))
    for kind, names in CONTRACTS.items():
        out = out.when(text.isin(names), made(kind, "exact"))
    for kind, parts in CONTRACT_PARTS.items():
        out = out.when(text.rlike(parts), made(kind, "alias"))
    return out.otherwise(made("other", "unresolved"))

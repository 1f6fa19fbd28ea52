"""Product texts as Column expressions: title case, weights, descriptions and clean-ups."""

from __future__ import annotations

import re
import unicodedata
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from gondola.dictionaries import ACCENTS, ACRONYMS, CONNECTIVES, MODIFIERS, NOUNS, TYPOS
from gondola.functions.binding import let

NUMBER = r"([0-9]+(?:[.,][0-9]+)?)"
#: ASCII word boundaries: Java's \b also stops at accented letters.
START, END = r"(?<![A-Za-z0-9_])", r"(?![A-Za-z0-9_])"
SPACE = r"[\s   -     　﻿]"


def text_or(column: Column, *others: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in (column, *others)])


def squeeze(text: Column) -> Column:
    """White-space runs become one space; none at the ends."""
    return F.btrim(F.regexp_replace(text, SPACE + "+", " "))


def _lookup() -> Column:
    return F.create_map(*[F.lit(x) for pair in ACCENTS.items() for x in pair])


def _capital(word: Column) -> Column:
    return F.concat(F.upper(F.substring(word, 1, 1)), F.lower(F.substring(word, 2, 1 << 20)))


def _title_core(core: Column, index: Column) -> Column:
    """A word without the signs around it."""

    def cased(low: Column) -> Column:
        accents = _lookup()
        known = F.try_element_at(accents, low)
        part = lambda p, i: F.coalesce(
            F.try_element_at(accents, F.lower(p)), F.when((i > 0) & F.lower(p).isin(*CONNECTIVES), F.lower(p)).otherwise(_capital(p))
        )
        return F.coalesce(
            known,
            F.when((index > 0) & low.isin(*CONNECTIVES), low)
            .when(F.substring(core, 2, 1 << 20).contains("-"), F.array_join(F.transform(F.split(core, "-"), part), "-"))
            .otherwise(_capital(core)),
        )

    return let(F.lower(core), cased)


def _title_word(word: Column, index: Column) -> Column:
    lead = F.regexp_extract(word, r"""^[(\["']+""", 0)
    trail = F.regexp_extract(word, r"""[)\].,"':;!?]+$""", 0)

    def peeled(ends: Column) -> Column:
        inner = F.substring(word, F.length(ends["lead"]) + 1, F.length(word) - F.length(ends["lead"]) - F.length(ends["trail"]))
        return let(inner, lambda core: F.when(F.length(core) <= 0, word).otherwise(F.concat(ends["lead"], _title_core(core, index), ends["trail"])))

    return (
        F.when(word.rlike(rf"(?i)^{NUMBER}(kg|g)$"), F.lower(word))
        .when(F.upper(word).isin(*ACRONYMS), F.upper(word))
        .otherwise(let(F.struct(lead.alias("lead"), trail.alias("trail")), peeled))
    )


def title_case(text: Column) -> Column:
    """Brazilian title case with accents repaired; units in lower and acronyms in upper case."""
    clean = squeeze(F.regexp_replace(F.coalesce(text, F.lit("")), "[•|~]", " "))
    return squeeze(F.array_join(F.transform(F.split(clean, " "), _title_word), " "))


def weight(text: Column) -> Column:
    """struct(grams, fractional, label) of the first weight or volume that a text states."""
    return let(F.lower(text), _weight)


def _weight(low: Column) -> Column:
    find = lambda pattern, group: F.nullif(F.regexp_extract(low, pattern, group), F.lit(""))
    number = lambda s: F.replace(s, F.lit(","), F.lit(".")).try_cast("double")
    grams = lambda x: F.floor(x + 0.5).cast("long")
    pack = rf"([0-9]+)\s*x\s*{NUMBER}\s*(kg|g|l|ml){END}"
    times, each, unit = find(pack, 1).try_cast("double"), number(find(pack, 2)), find(pack, 3)
    shown = lambda x: F.regexp_replace(F.regexp_replace(x.cast("decimal(20,6)").cast("string"), r"0+$", ""), r"\.$", "")
    pieces = [(rf"{NUMBER}\s*{u}{END}", u, f) for u, f in (("l", 1000), ("ml", 1), ("kg", 1000), ("g", 1))]
    open_ = low.rlike(rf"{START}(peso\s+vari[aá]vel|a\s+granel){END}") | (
        low.rlike(rf"{START}pesar{END}") & ~low.rlike(rf"{START}{NUMBER}\s*(kg|g|l|ml){END}")
    )
    made = lambda g, s: F.struct(g.alias("grams"), F.lit(False).alias("fractional"), s.alias("label"))
    none = F.struct(F.lit(None).cast("long").alias("grams"), F.lit(True).alias("fractional"), F.lit(None).cast("string").alias("label"))
    out = F.when(F.coalesce(low, F.lit("")) == "", none).when(open_, none)
    out = out.when(
        each.isNotNull(),
        made(grams(times * each * F.when(unit.isin("kg", "l"), 1000).otherwise(1)), F.concat(shown(times), F.lit("x"), shown(each), unit)),
    )
    for pattern, u, factor in pieces:
        hit = find(pattern, 1)
        applies = hit.isNotNull() if u != "l" else hit.isNotNull() & ~low.rlike("lingui[cç]a")
        out = out.when(applies, made(grams(number(hit) * factor), F.concat(hit, F.lit(u))))
    return out.otherwise(none)


def weight_label(grams: Column) -> Column:
    """1200 -> 1,2kg; 950 -> 950g; thousands of kilograms with a point."""
    kilos = F.regexp_replace(F.regexp_replace(F.format_number(grams / 1000, 3), r"0+$", ""), r"\.$", "")
    return F.when(grams >= 1000, F.concat(F.translate(kilos, ".,", ",."), F.lit("kg"))).otherwise(F.concat(grams.cast("string"), F.lit("g")))


def described(title: Column, grams: Column, fractional: Column) -> dict[str, Column]:
    """Columns _clean and _parsed, to be added before description() is used."""
    parsed = weight(title)
    rounded = F.floor(grams + 0.5).cast("long")
    known = parsed["grams"].isNull() & (grams > 0) & ~F.coalesce(fractional, F.lit(False))
    filled = F.when(
        F.coalesce(known, F.lit(False)), F.struct(rounded.alias("grams"), F.lit(False).alias("fractional"), weight_label(rounded).alias("label"))
    ).otherwise(
        F.struct(
            parsed["grams"].alias("grams"),
            F.when(fractional, F.lit(True)).when(~fractional & parsed["grams"].isNotNull(), F.lit(False)).otherwise(parsed["fractional"]).alias("fractional"),
            parsed["label"].alias("label"),
        )
    )
    return {"_clean": title_case(title), "_parsed": filled}


def description(clean: Column, parsed: Column) -> Column:
    """Title with its weight, or with "(pesar)" if sold by weight."""
    open_ = F.when(clean.rlike(r"(?i)\(pesar\)"), clean).otherwise(
        F.concat(F.btrim(F.regexp_replace(clean, r"(?i)\s+fracionad[oa]", "")), F.lit(" (pesar)"))
    )
    bare = F.btrim(F.regexp_replace(clean, r"(?i)\s*\(pesar\)", ""))
    # the label's number may be written with a point or a comma: only its first point is loose
    number = F.regexp_replace(parsed["label"], "[^0-9.,]", "")
    unit = F.regexp_replace(parsed["label"], "[0-9.,]", "")
    loose = F.concat(F.lit(rf"(?i){START}"), F.regexp_replace(number, r"^([^.]*)\.", "$1[.,]"), F.lit(r"\s*"), unit, F.lit(END))
    whole = F.when(F.regexp_like(bare, loose), bare).otherwise(F.concat(bare, F.lit(" "), parsed["label"]))
    return F.when(parsed["fractional"] | parsed["grams"].isNull(), open_).otherwise(whole)


def repair_typos(text: Column) -> Column:
    return reduce(lambda acc, pair: F.regexp_replace(acc, "(?i)" + pair[0], pair[1]), TYPOS.items(), F.btrim(F.coalesce(text, F.lit(""))))


def drop_conservation(text: Column) -> Column:
    return squeeze(F.regexp_replace(text, rf"(?i)\s*[•\-/,]?\s*(congelada|congelado|resfriada|resfriado){END}", ""))


def _foldings() -> dict[str, str]:
    """Characters with a compatibility decomposition that holds an ASCII letter or digit, and that decomposition without marks."""
    plain = {c: re.sub("[\u0300-\u036f]", "", unicodedata.normalize("NFKD", c)) for c in map(chr, (*range(0x80, 0xD800), *range(0xE000, 0x10000)))}
    return {c: p for c, p in plain.items() if c != p and re.search("[A-Za-z0-9]", p)}


_FOLDED = {c: p for c, p in _foldings().items() if len(p) == 1}
#: Ligatures, units, fractions and the like.
_SPREAD = {c: p for c, p in _foldings().items() if len(p) > 1}


def _spread(text: Column) -> Column:
    """Characters that decompose into several, taken apart; texts without any are left as they are."""
    table = F.create_map(*[F.lit(x) for pair in _SPREAD.items() for x in pair])
    apart = F.array_join(F.transform(F.split(text, ""), lambda c: F.coalesce(F.try_element_at(table, c), c)), "")
    return F.when(text.rlike("[" + "".join(_SPREAD) + "]"), apart).otherwise(text)


def _unaccented(text: Column) -> Column:
    bare = F.regexp_replace(let(text, _spread), "[\u0300-\u036f]", "")
    return F.translate(bare, "".join(_FOLDED), "".join(_FOLDED.values()))


def plain_words(text: Column) -> Column:
    """Lower case without accents (composed or combining), compatibility characters taken apart, anything but letters and digits a space."""
    # the long tables are looked at for texts with other characters than ASCII's alone
    low = let(F.coalesce(text, F.lit("")), lambda t: F.lower(F.when(t.rlike("[^\\x00-\\x7F]"), _unaccented(t)).otherwise(t)))
    return squeeze(F.regexp_replace(low, r"[^a-z0-9\s]", " "))


def weight_token(text: Column) -> Column:
    found = F.regexp_extract(F.lower(text), rf"{START}([0-9]+(?:[.,][0-9]+)?\s*(?:g|kg|ml|l)){END}", 1)
    return F.nullif(F.regexp_replace(F.regexp_replace(found, r"\s+", ""), ",", "."), F.lit(""))


def supplier_grams(text: Column) -> Column:
    """Grams of the first number with kg or g."""
    pattern = rf"([0-9]+[.,]?[0-9]*)\s*(kg|g){END}"
    low = F.lower(text)
    value = F.replace(F.nullif(F.regexp_extract(low, pattern, 1), F.lit("")), F.lit(","), F.lit(".")).try_cast("double")
    return F.floor(value * F.when(F.regexp_extract(low, pattern, 2) == "kg", 1000).otherwise(1) + 0.5).cast("long")


def noun_tags(text: Column) -> Column:
    """Groups whose nouns a text holds, in the table's order."""
    tags = lambda plain: F.array(*[F.when(reduce(lambda a, b: a | b, [plain.contains(n) for n in nouns]), F.lit(g)) for g, nouns in NOUNS.items()])
    return F.filter(let(plain_words(text), tags), lambda t: t.isNotNull())


def modifiers(plain: Column) -> Column:
    """The modifiers that a plain text holds, as one string of flags."""
    return F.concat(*[F.when(plain.contains(m), F.lit("1")).otherwise(F.lit("0")) for m in MODIFIERS])


def slugify(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-|-$", "")


def safe_id(text: Column) -> Column:
    return F.regexp_replace(text, "[^a-zA-Z0-9_-]", "_")


def drop_trailing_number(text: Column) -> Column:
    return F.btrim(F.regexp_replace(text, r"\s*\([0-9]+\)\s*$", ""))


def strip_brand(title: Column, brands: list[str]) -> Column:
    any_ = "|".join(brands)
    return F.btrim(F.regexp_replace(F.regexp_replace(title, rf"(?i)^({any_})\s*[-|]\s*", ""), rf"(?i)\s*[-|]\s*({any_})$", ""))


def sheet_name(text: Column, length: int = 31) -> Column:
    return F.substring(F.regexp_replace(text, r"[\\/?*\[\]:]", "_"), 1, length)


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*?)(?:\.[^./]*)?$", 1)

"""The queries of the text problems, p8 to p10, and their SQL."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import canonical, leakage, packing
from tidemark.sources.tables import table

#: A run of so many shared words is a leak; by coverage, tiles of five words over four fifths of an item are.
SHARED_WORDS, TILE_WORDS, COVERAGE = 12, 5, 0.8


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    return packing.containers(table(spark, d, "documents"), "doc_id", "text")


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    """How full the containers are, in one row."""
    return packing.fill(p8_containers(spark, d))


def p8_holds(spark: SparkSession, d: str) -> DataFrame:
    """What a packing must hold to, with the tokens of every text counted again."""
    sized = packing.lengths(table(spark, d, "documents"), "doc_id", "text")
    return packing.holds(p8_containers(spark, d), sized)


def _leaks(spark: SparkSession, d: str, **how) -> DataFrame:
    return leakage.leaks(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_items"), "item_id", "item_text", **how)


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d, min_words=SHARED_WORDS).select("doc_id", "item_id")


def p9_covered(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold most of an item, in any order."""
    return _leaks(spark, d, min_words=TILE_WORDS, min_coverage=COVERAGE)


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return canonical.look_alikes(table(spark, d, "documents"), "doc_id", "text")


def p10_canonical(spark: SparkSession, d: str) -> DataFrame:
    """Every text in its consistent form."""
    return canonical.canonical(table(spark, d, "documents").select("doc_id", "text"), "text").select("doc_id", "canonical")


def p10_classes(spark: SparkSession, d: str) -> DataFrame:
    """Every document with the class of its look."""
    return canonical.classes(table(spark, d, "documents"), "doc_id", "text")


QUERIES = {f.__name__: f for f in (p8_containers, p8_fill, p8_holds, p9_found, p9_covered, p10_found, p10_canonical, p10_classes)}


# The SQL below goes its own way to the form: character by character through a map, with the character classes of
# regular expressions, so that it shares neither expression nor table with the operators.

# Letters that show as a Latin one, each before it.
_PAIRS = """АA ВB ЕE ЅS ІI ЈJ КK МM НH ОO РP СC ТT УY ХX ҮY ԚQ ԜW ӀI аa еe оo рp сc уy хx іi јj ѕs һh ԁd ԛq ԝw ӏl үy
ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX ϹC ͿJ οo ϲc ϳj νv ՕO ՍU ՏS օo սu ոn հh զq ցg ɑa ɡg ‐- ‑-
ꓐB ꓑP ꓓD ꓔT ꓖG ꓗK ꓙJ ꓚC ꓜZ ꓝF ꓟM ꓠN ꓡL ꓢS ꓣR ꓦV ꓧH ꓪW ꓫX ꓬY ꓮA ꓰE ꓲI ꓳO ꓴU ᎠD ᎡR ᎢT ᎪA ᎫJ ᎬE ᎳW ᎷM ᎻH ᏀG ᏃZ Ꮞ4 ᏙV ᏚS ᏞL ᏟC ᏢP ᏦK"""


def _shown() -> dict[str, str]:
    """What each character that shows as others shows, found by decomposing it fully."""
    look = {pair[0]: pair[1] for pair in _PAIRS.split()}
    out = {}
    for code in range(0x80, 0x20000):
        c = chr(code)
        tag = unicodedata.decomposition(c).split(" ")[0]
        wide = unicodedata.normalize("NFKC", c) if tag in ("<wide>", "<narrow>", "<font>", "<noBreak>") or (tag == "<compat>" and c.isalpha() and unicodedata.category(c) != "Lo" and unicodedata.category(c) != "Lm") else c
        if wide.startswith(" ") or (tag == "<compat>" and not wide.isalpha()):
            wide = c
        parts = unicodedata.normalize("NFD", wide)
        shown = unicodedata.normalize("NFC", "".join(look.get(x, x) for x in parts)) if any(x in look for x in parts) else wide
        if shown != c and unicodedata.category(c)[0] != "Z":
            out[c] = shown
    return out


_TEXT = lambda x: "'" + x.replace("'", "''") + "'"
_MAP = "MAP {" + ", ".join(f"{_TEXT(a)}: {_TEXT(b)}" for a, b in _shown().items()) + "}"


def _form(column: str) -> str:
    hidden = "[\\p{Cf}\\x{34F}\\x{115F}\\x{1160}\\x{3164}\\x{FFA0}\\x{FE00}-\\x{FE0F}\\x{E0100}-\\x{E01EF}]"
    plain = f"nfc_normalize(regexp_replace(regexp_replace({column}, '{hidden}', '', 'g'), '[\\p{{Zs}}\\t]', ' ', 'g'))"
    shown = f"array_to_string(list_transform(regexp_extract_all({plain}, '(?s).'), lambda c: CASE WHEN c < chr(128) THEN c ELSE coalesce(shown.m[c], c) END), '')"
    return f"replace(nfc_normalize({shown}), chr(13) || chr(10), chr(10))"


def _with_form(sql: str) -> str:
    return f"WITH shown AS (SELECT {_MAP} AS m), {sql}"


_FORMS = f"f AS (SELECT doc_id, text, {_form('text')} AS form FROM documents, shown WHERE text IS NOT NULL)"


def _runs(name: str, id_: str, text: str, source: str) -> str:
    """Twelve words in a row, by the look of their capitals; v is one with n and l with i, as Greek nu and palochka join them."""
    raised = f"{name}_up AS (SELECT {id_} AS id, upper({_form(text)}) AS up FROM {source}, shown WHERE {text} IS NOT NULL)"
    words = f"{name}_words AS (SELECT id, regexp_extract_all(replace(replace(lower({_form('up')}), 'v', 'n'), 'l', 'i'), '[\\p{{L}}\\p{{M}}\\p{{N}}]+') AS w FROM {name}_up, shown)"
    return f"{raised}, {words}, {name} AS (SELECT DISTINCT id, array_to_string(w[i:i+11], ' ') AS run FROM (SELECT id, w, unnest(range(1, len(w) - 10)) AS i FROM {name}_words))"


SQL = {
    "p8_holds": "SELECT count(*) AS documents, 0 AS over_full, 0 AS ids_missing, 0 AS tokens_changed, 0 AS split_needlessly, 0 AS apart FROM documents",
    "p9_found": _with_form(f"{_runs('d', 'doc_id', 'text', 'documents')}, {_runs('i', 'item_id', 'item_text', 'eval_items')} SELECT DISTINCT d.id AS doc_id, i.id AS item_id FROM d JOIN i USING (run)"),
    "p10_found": _with_form(f"{_FORMS} SELECT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM f a JOIN f b ON a.form = b.form AND a.doc_id < b.doc_id AND a.text <> b.text"),
    "p10_canonical": _with_form(f"{_FORMS} SELECT d.doc_id, f.form AS canonical FROM documents d LEFT JOIN f ON f.doc_id = d.doc_id"),
    "p10_classes": _with_form(f"{_FORMS} SELECT doc_id, min(doc_id) OVER (PARTITION BY form) AS class_id, n AS n_texts FROM f JOIN (SELECT form, count(DISTINCT text) AS n FROM f GROUP BY form) USING (form)"),
}

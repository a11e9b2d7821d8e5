"""One consistent form of text that looks the same: full-width letters, accents as
marks of their own, invisible characters, all kinds of spaces, look-alike letters.

The mapping is SQL that DuckDB runs over each Arrow batch inside Spark's
partitions (``nfc_normalize``, ``translate``, ``replace`` and ``regexp_replace``).
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.session import cut_lineage

# Letters of other scripts that are drawn like a Latin letter, and that letter.
CYRILLIC = "АВЕЅІЈКМНОРСТУХҮԚԜӀ" "аеорсухіјѕһԁԛԝӏү"
CYRILLIC_AS = "ABESIJKMHOPCTYXYQWI" "aeopcyxijshdqwly"
GREEK = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹͿ" "οϲϳν"
GREEK_AS = "ABEZHIKMNOPTYXCJ" "ocjv"
# Letters of smaller scripts whose shape is that of a Latin capital or, last, small letter, and hyphens like the common one.
LISU, LISU_AS = "ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPDTGKJCZFMNLSRVHWXYAEIOU"
CHEROKEE, CHEROKEE_AS = "ᎠᎡᎢᎪᎫᎬᎳᎷᎻᏀᏃᏎᏙᏚᏞᏟᏢᏦ", "DRTAJEWMHGZ4VSLCPK"
ARMENIAN, ARMENIAN_AS = "ՕՍՏօսոհզց", "OUSounhqg"
LATIN, LATIN_AS = "ɑɡ‐‑", "ag--"
# Line ends and the control characters that show nothing.
TAB, RETURN = "\t", "\r"


def _kinds() -> tuple[dict[str, str], dict[str, str]]:
    """Compatibility forms of one character that show the same letters, by the character database: to one character and to several.

    Forms that look different (raised, lowered, circled, squared, fractions) are
    not among them, nor are forms that stand for a space and a mark.
    """
    one, several = {}, {}
    for code in range(0x80, 0x20000):
        char = chr(code)
        kind, _, rest = unicodedata.decomposition(char).partition(" ")
        if kind not in ("<wide>", "<narrow>", "<font>", "<compat>", "<noBreak>"):
            continue
        to = unicodedata.normalize("NFKC", char)
        if unicodedata.category(char) == "Zs":
            continue
        if to.startswith(" ") or (kind == "<compat>" and not (to.isalpha() and unicodedata.category(char) in ("Ll", "Lu", "Lt"))):
            continue
        (one if len(to) == 1 else several)[char] = to
    return one, several


def _in_class(chars: str) -> str:
    """The characters for a class of a regular expression, neighbours as ranges."""
    out: list[list[int]] = []
    for code in sorted(map(ord, set(chars))):
        if out and out[-1][1] == code - 1:
            out[-1][1] = code
        else:
            out.append([code, code])
    return "".join(f"\\x{{{a:X}}}" if a == b else f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in out)


@lru_cache(maxsize=1)
def tables() -> dict[str, str | dict[str, str]]:
    """What the SQL is made of: look-alikes, accented look-alikes, compatibility forms, spaces, invisible characters."""
    compat, several = _kinds()
    alike = dict(zip(CYRILLIC + GREEK + LISU + CHEROKEE + ARMENIAN + LATIN, CYRILLIC_AS + GREEK_AS + LISU_AS + CHEROKEE_AS + ARMENIAN_AS + LATIN_AS, strict=True))
    marked: dict[str, str] = {}
    # Accented letters of those scripts (NFC keeps them whole) look like the accented Latin letter, where there is one.
    for code in range(0x370, 0x530):
        parts = unicodedata.normalize("NFD", chr(code))
        if len(parts) > 1 and parts[0] in alike:
            to = unicodedata.normalize("NFC", alike[parts[0]] + parts[1:])
            if len(to) == 1:
                alike[chr(code)] = to
            else:
                several[chr(code)] = marked[chr(code)] = to
    every = [chr(c) for c in range(0x80, 0x20000)] + [chr(c) for c in range(0xE0000, 0xE0200)]
    spaces = "".join(c for c in every if unicodedata.category(c) == "Zs") + TAB
    hidden = "".join(c for c in every if unicodedata.category(c) == "Cf") + "".join(chr(c) for c in [*range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0), 0x34F, 0x115F, 0x1160, 0x3164, 0xFFA0])
    compat = {a: alike.get(b, b) for a, b in compat.items() if a not in hidden and a not in alike}
    return {"compat": compat, "several": several, "spaces": spaces, "hidden": hidden, "alike": alike, "marked": marked}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _translated(column: str, table: dict[str, str]) -> str:
    """``column`` with the table's characters replaced; DuckDB prepares the table for every text, so texts without any of them pass by."""
    some = f"regexp_matches({column}, '[{_in_class(''.join(table))}]')"
    return f"CASE WHEN {some} THEN translate({column}, {_quoted(''.join(table))}, {_quoted(''.join(table.values()))}) ELSE {column} END"


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` for ``value``, which is worked out once where ``body`` has it several times."""
    return f"list_transform([{value}], lambda {name}: {body})[1]"


@lru_cache(maxsize=1)
def sql(column: str = "text") -> str:
    """The DuckDB expression for the consistent form of ``column``.

    Plain ASCII needs no work but tabs, so the rest runs only where a text has
    more. Hidden characters go first, so that a mark behind one joins its letter.
    What becomes several characters is looked for after that, as it may come out of a letter and its mark.
    """
    t = tables()
    shown = f"regexp_replace({column}, '[{_in_class(t['hidden'])}]', '', 'g')"
    spaced = f"regexp_replace({shown}, '[{_in_class(t['spaces'])}]', ' ', 'g')"
    plain = _let("raw", f"nfc_normalize({spaced})", _translated("raw", t["compat"]))
    alike = _let("wide", plain, _translated("wide", t["alike"]))
    ligatures = "one"
    for a, b in t["several"].items():
        ligatures = f"replace({ligatures}, {_quoted(a)}, {_quoted(b)})"
    rest = _let("one", alike, f"nfc_normalize(CASE WHEN regexp_matches(one, '[{_in_class(''.join(t['several']))}]') THEN {ligatures} ELSE one END)")
    ascii_only = f"regexp_matches({column}, '^[\\x00-\\x7F]*$')"
    return f"replace(CASE WHEN {ascii_only} THEN replace({column}, chr(9), ' ') ELSE {rest} END, chr(13) || chr(10), chr(10))"


@lru_cache(maxsize=1)
def look_sql(column: str = "text") -> str:
    """The DuckDB expression that brings look-alike letters in ``column`` to the consistent form, where all else is in it already, as in a form whose case was changed."""
    t = tables()
    alike = _translated(column, t["alike"])
    marked = alike
    for a, b in t["marked"].items():
        marked = f"replace({marked}, {_quoted(a)}, {_quoted(b)})"
    some = f"regexp_matches({column}, '[{_in_class(''.join(t['marked']))}]')"
    return f"CASE WHEN regexp_matches({column}, '^[\\x00-\\x7F]*$') THEN {column} WHEN {some} THEN {marked} ELSE {alike} END"


def run_in_duckdb(df: DataFrame, query: str, schema: T.StructType) -> DataFrame:
    """``query`` over each Arrow batch of ``df``, seen as the table ``batch``, in an in-process DuckDB of one thread."""

    def work(batches: Iterator) -> Iterator:
        import duckdb
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        wanted = to_arrow_schema(schema)
        con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
        try:
            for batch in batches:
                con.register("batch", pa.Table.from_batches([batch]))
                out = con.sql(query).to_arrow_table()
                con.unregister("batch")
                yield from out.cast(wanted).to_batches()
        finally:
            con.close()

    return df.mapInArrow(work, schema)


def canonical(df: DataFrame, text: str, to: str = "canonical") -> DataFrame:
    """Adds ``to``, the consistent form of ``text``; other columns pass through, one named ``to`` is replaced.

    Null stays null and an empty text empty. Case, accents, punctuation, line
    breaks and the number of spaces are kept; the kind of a space isn't. The
    form is idempotent. Whole texts of any length are mapped.
    """
    names = [c for c in df.columns if c != to]
    plain = df.select(*names)
    schema = T.StructType([*plain.schema.fields, T.StructField(to, T.StringType())])
    quoted = ", ".join(f'"{n}"' for n in names)
    column = f'"{text}"'
    return run_in_duckdb(plain, f'SELECT {quoted}, {sql(column)} AS "{to}" FROM batch', schema)


def fingerprints(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id, form, exact``: 128-bit hashes of the consistent form and of the text itself. Null texts are left out.

    Written to the shared checkpoint folder, since what follows reads them twice:
    under 100 bytes a document, against bringing every text into its form again.
    """
    narrow = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).filter(F.col("text").isNotNull())
    schema = T.StructType([T.StructField("doc_id", df.schema[doc_id].dataType), T.StructField("form", T.StringType()), T.StructField("exact", T.StringType())])
    return cut_lineage(run_in_duckdb(narrow, f"SELECT doc_id, md5({sql('text')}) AS form, md5(text) AS exact FROM batch", schema))


def look_alikes(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id_a < doc_id_b``: documents of one consistent form whose texts differ.

    Forms with one text only, be they on ever so many documents, are dropped by a
    partial aggregation before anything is paired. In the rest the different texts of a
    form are paired, each once, and only then joined with their documents: ever
    so many copies of a text are never compared with each other.
    """
    prints = fingerprints(df, doc_id, text)
    forms = prints.groupBy("form").agg(F.min("exact").alias("lo"), F.max("exact").alias("hi")).filter("lo <> hi").select("form")
    some = prints.join(forms, "form", "left_semi")
    texts = some.select("form", "exact").distinct()
    a, b = (texts.withColumnRenamed("exact", name) for name in ("text_a", "text_b"))
    pairs = a.join(b, "form").filter("text_a < text_b").select("text_a", "text_b")
    copies = lambda name: some.select(F.col("exact").alias(f"text_{name}"), F.col("doc_id").alias(f"doc_{name}")).distinct()
    both = pairs.join(copies("a"), "text_a").join(copies("b"), "text_b")
    return both.select(F.least("doc_a", "doc_b").alias("doc_id_a"), F.greatest("doc_a", "doc_b").alias("doc_id_b")).filter("doc_id_a < doc_id_b").distinct()


def classes(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row a document: ``doc_id``, ``class_id`` (the lowest id of its form) and ``n_texts``, the different texts of that form."""
    prints = fingerprints(df, doc_id, text)
    forms = prints.groupBy("form", "exact").agg(F.min("doc_id").alias("first")).groupBy("form").agg(F.min("first").alias("class_id"), F.count(F.lit(1)).alias("n_texts"))
    return prints.join(forms, "form").select("doc_id", "class_id", "n_texts")

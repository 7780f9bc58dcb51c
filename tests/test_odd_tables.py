"""Queries against their SQL on small tables of the values where Spark and DuckDB part ways."""

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from test_oracle import rows

import __spark_entry__ as entry

#: An accented letter is no word character to the SQL's patterns: each "éa" has a letter that stands alone.
ACCENTED = ["éa " * 12, "à b ç d " * 6, "a b c d e f g h i j", "éab " * 12, "naïve café " * 9, "á b́ " * 8, "ñ" * 40, None, ""]


def same(spark, folder, name, **tables):
    con = duckdb.connect()
    for t, data in tables.items():
        pq.write_table(pa.table(data), f"{folder}/{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    cursor = con.execute(entry.oracle_sql()[name])
    wanted = rows([d[0] for d in cursor.description], cursor.fetchall())
    df = entry.queries()[name](spark, str(folder))
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == wanted


def documents(texts):
    n = len(texts)
    return {"doc_id": pa.array(range(n), pa.int64()), "text": pa.array(texts, pa.string()), "lang": ["fr", "de"] * (n // 2) + ["fr"] * (n % 2), "source": ["web"] * n}


def test_readability_of_accented_letters(spark, tmp_path):
    same(spark, tmp_path, "readability_metrics", documents=documents(ACCENTED))


def test_quality_of_accented_letters(spark, tmp_path):
    filler = "one two three four six ten red blue cold old new hot ring rod gear bolt saw cut dye ink jar key log map nut oak pin"
    words = ["éresults", "réfindings", "méthodeédoi", "issné", "bibliographyé", "résumé methodsé", "Smithé et al 2001 ÉSmith et al 2001 " * 7, "é1999 [1] " * 12, "largerñ smallest² " * 14, "smallest " * 14]
    texts = [*ACCENTED, *(f"{filler} {w} {w}." for w in words), *(f"{w} {filler} doié citationé journal" for w in words), "é publishedé é license doié " * 4]
    same(spark, tmp_path, "chunk_quality", documents=documents(texts))


#: Readable but for single letters beside accented ones, which lower the score from over 0.75 to under it.
SPACED = "éa " * 10 + "seven sunny brown foxes jumped across wooden garden fences while quick silver rivers carried yellow leaves towards distant mountain valleys under clear skies"


def judged():
    texts = [SPACED, SPACED, SPACED.replace("éa ", ""), "x"]
    return {"documents": documents(texts), "labels": {"doc_id": pa.array(range(4), pa.int64()), "quality": pa.array([0, 1, 1, 0], pa.int32()), "toxic": pa.array([0] * 4, pa.int32())}}


@pytest.mark.parametrize("name", ["mismatch_sheet", "screening_confusion", "screening_metrics"])
def test_decisions_on_accented_letters(spark, tmp_path, name):
    same(spark, tmp_path, name, **judged())


def repeated():
    """Ids that documents or labels hold more than once, in several languages, and decisions or languages that are not known."""
    good = SPACED.replace("éa ", "")
    docs = {"doc_id": pa.array([0, 0, 0, 1, 1, 2, 3, 4, 5, None], pa.int64()), "text": pa.array([good, "x", "x", good, good, None, good, good, "x", good], pa.string()), "lang": ["fr", "de", "en", "fr", "fr", "en", None, "it", "it", "fr"], "source": ["web"] * 10}
    return {"documents": docs, "labels": {"doc_id": pa.array([0, 1, 1, 2, 2, 3, 4, 5, None], pa.int64()), "quality": pa.array([0, 0, 1, 1, 0, 0, None, None, 1], pa.int32()), "toxic": pa.array([0] * 9, pa.int32())}}


@pytest.mark.parametrize("name", ["mismatch_sheet", "screening_confusion", "screening_metrics"])
def test_decisions_of_repeated_ids(spark, tmp_path, name):
    same(spark, tmp_path, name, **repeated())


def newer():
    """Letters and numbers that are younger than Java 17: as characters of a text they raise its score over 0.75, as words of their own they lower it under that."""
    kana, han, digit = "\U0001aff0", "\U00031350", "\U00016ac0"
    longer = ["seven sunny brown horse field " + c * 20 for c in (kana, han, digit)]
    alone = ["abcdefghij " * 20 + f"{c} " * 10 + "-" * 39 for c in (kana, han, digit)]
    texts = [*longer, *alone, f"{kana}. ({han}) {digit}{kana} x{han} {digit}_", "seven sunny brown horses"]
    return {"documents": documents(texts), "labels": {"doc_id": pa.array(range(8), pa.int64()), "quality": pa.array([1, 1, 1, 0, 0, 0, 0, 1], pa.int32()), "toxic": pa.array([0] * 8, pa.int32())}}


@pytest.mark.parametrize("name", ["readability_metrics", "screening_confusion"])
def test_decisions_on_newer_letters(spark, tmp_path, name):
    same(spark, tmp_path, name, **newer())


def test_attempts_at_halves(spark, tmp_path):
    values = [50.0, 150.0, 250.0, 350.0, 249.99999, 250.00001, None, -50.0, -150.0, 0.0]
    same(spark, tmp_path, "retry_attempts", events={"user_id": pa.array(range(10), pa.int64()), "value": pa.array(values, pa.float64())})

from collections import defaultdict

import pytest
from llm_data import docs

from stockgap.llm import line_dedup, queries


def _brute(rows, min_sites=line_dedup.MIN_SITES):
    sites, first = defaultdict(set), {}
    for i, text, site in rows:
        for pos, line in enumerate((text or "").split("\n")):
            key = line.strip(" ")
            if key:
                sites[key].add(site or "")
                place = ((1 << 63) - 1 if i is None else i, pos)
                first[key] = min(first.get(key, place), place)
    out = []
    for i, text, _ in rows:
        keep = [line for pos, line in enumerate((text or "").split("\n"))
                if not line.strip(" ") or len(sites[line.strip(" ")]) < min_sites or first[line.strip(" ")] == ((1 << 63) - 1 if i is None else i, pos)]
        out.append((i, None if text is None else "\n".join(keep)))
    return sorted(out, key=str)


def _case():
    rows = [(i, f"own line number {i}\nall over the place\n  four sites at most \nun.", f"s{i % 7}") for i in range(1, 30)]
    rows = [(i, t if int(s[1]) < 4 else t.replace("  four sites at most ", "none"), s) for i, t, s in rows]
    rows += [(100 + i, "just five sites here" if i < 5 else "", f"s{i}") for i in range(8)]
    rows += [(None, "all over the place\nall over the place", None), (40, None, "s1"), (41, "", None), (42, "all over the place", "s9")]
    return rows


def test_against_brute_force(spark):
    rows = _case()
    got = line_dedup.clean(docs(spark, rows))
    assert got.columns == docs(spark, rows).columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == _brute(rows)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got.collect())


def test_coarse_sketches_leave_the_decision_to_exact_counts(spark):
    rows = [(i, "\n".join(f"line of spread {k} here" for k in range(40) if i < k), f"s{i}") for i in range(40)]
    got = line_dedup.clean(docs(spark, rows), min_sites=20, lg_k=4)
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == _brute(rows, 20)


def test_empty_table_and_repeated_rows(spark):
    assert line_dedup.clean(docs(spark, [])).count() == 0
    rows = [(7, "same line on many", f"s{i % 6}") for i in range(12)] + [(8, "same line on many\nnew words are here", "s1")] * 2
    got = sorted(r.text for r in line_dedup.clean(docs(spark, rows)).collect())
    assert got == ["new words are here"] * 2 + ["same line on many"] * 12


def test_short_lines_and_scripts_without_spaces(spark):
    """Every line that is not blank counts: one word, two words, a Chinese passage, a tab."""
    chinese, long = "这是一个没有空格的很长的段落" * 10, "a long line " * 20000
    rows = [(i, f"\n\n{chinese}\nThing.\nTwo words\n\t\n{long}\n \nown {i}", f"s{i % 6}") for i in range(12)]
    rows += [(50 + i, "only on four", f"s{i}") for i in range(4)]
    got = sorted((r.doc_id, r.text) for r in line_dedup.clean(docs(spark, rows)).collect())
    assert got == sorted(_brute(rows)) and got[1][1] == "\n\n \nown 1" and got[0][1] == rows[0][1]


def test_clashing_columns(spark):
    rows = [(i, "same line\nown", f"s{i}") for i in range(6)]
    df = docs(spark, rows).selectExpr("*", "'x' AS __drop", "1 AS id", "2 AS HASH", "3 AS n", "4 AS _n")
    got = line_dedup.clean(df, removed="gone")
    assert got.columns == [*df.columns, "gone"] and sorted(r.gone for r in got.collect()) == [0, 1, 1, 1, 1, 1]
    assert {(r["__drop"], r["id"], r["HASH"], r["n"], r["_n"]) for r in got.collect()} == {("x", 1, 2, 3, 4)}
    with pytest.raises(ValueError):
        line_dedup.clean(df, removed="n")


def test_registered_query(spark, tmp_path):
    rows = _case()
    docs(spark, rows).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op7_line_dedup"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_removed", "n_chars", "text"]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == _brute(rows)

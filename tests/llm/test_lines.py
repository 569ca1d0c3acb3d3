from __future__ import annotations

from tallyloom.llm.lines import drop_boilerplate


def expected(rows, least):
    sites, first = {}, {}
    for i, text, site in rows:
        for line in (text or "").split("\n"):
            if line.strip(" \t\r"):
                sites.setdefault(line, set()).update([site] if site is not None else [])
                if i is not None:
                    first[line] = min(first.get(line, i), i)
    out = []
    for i, text, _ in rows:
        lines = [] if text is None else text.split("\n")
        gone = [
            bool(x.strip(" \t\r")) and len(sites[x]) >= least and i is not None and first[x] < i for x in lines
        ]
        kept = None if text is None else "\n".join(x for x, g in zip(lines, gone, strict=True) if not g)
        out.append((i, kept, len(lines), sum(gone)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in df.collect()), key=str)


def test_same_as_exact_counts(spark, documents, words):
    rows = [(i, f"on all sites\n{words(8, i)}\n\n \nshared by {i % 40 // 4}", f"s{i % 40}") for i in range(300)]
    rows += [(400 + i, f"spread {n}\nspread {n}", f"s{i}") for n in range(6, 15) for i in range(n)]
    rows += [(900, None, "s1"), (901, "", "s2"), (902, "on all sites\r\n\ttab", None), (903, "on all sites", "s1")]
    rows += [(903, "on all sites", "s1"), (None, "on all sites\nx", "s3"), (904, "y\n" * 30_000 + "on all sites", "s4")]
    df = drop_boilerplate(spark, documents(rows, extra=True))
    assert got(df) == expected(rows, 10)
    assert {"body", "places", "row", "site", "lang"} - set(df.columns) == {"site"}


def test_threshold_is_exact(spark, documents):
    rows = [(k, f"line {n}", f"s{k % 1000}") for n in range(90, 111) for k in range(n)]
    rows = [(i, text, site) for i, (_, text, site) in enumerate(rows)]
    assert got(drop_boilerplate(spark, documents(rows), least_sites=100)) == expected(rows, 100)


def test_empty_table(spark, documents):
    assert drop_boilerplate(spark, documents([])).collect() == []

import os
import textwrap

import duckdb

from staykit.llm.licenses import LICENSES, LONG_TEXTS, ORACLE, SHORT_TEXTS, scan

MIT = "MIT License " + next(t for n, _, t in SHORT_TEXTS if n == "MIT")
SHORT = {n: t for n, _, t in SHORT_TEXTS}


def rows():
    apache = "Licensed under the Apache License, Version 2.0."
    long = [t for _, t in LICENSES]
    return [
        (1, None), (2, ""), (3, apache), (4, "LICENCED under the   apache licence;  version 2.0!"), (5, f"some prose\n{apache}\nmore"),
        (6, MIT), (7, "Copyright (c) 2020 Some One\n\n" + MIT.upper().replace(", ", ",\n")), (8, f"intro\n\n{MIT}\n\noutro " * 2),
        (9, "Licensed under the Apache License, Version 1.0."), (10, "Ärger " * 30_000 + "\n" + apache), (10, apache), (None, apache),
        (11, f"{apache}\n{apache}\nReleased under the MIT Licence"), (12, "Licensed under the Apache License, Version 2.0 ©"),
        (13, "Licence"), (14, "no such text"), (15, "SPDX-License-Identifier:MIT"),
    ] + [(100 + i, t) for i, t in enumerate(long)] + usual()


def usual():
    """Whole files as they are usually found: headings or none, notices, any wrapping, comment marks."""
    out = [(200, "Copyright 2020 J. Licensed under the Apache License, Version 2.0."),
           (201, "Copyright (c) 2020-2024 Jane Doe <j@x.org>; all rights reserved. Released under the MIT License."),
           (202, "copyright notice and this permission notice shall be included")]
    for i, name in enumerate(sorted(SHORT)):
        for width in (52, 60, 66, 72, 78):                  # some lines then begin with "copyright"
            body = textwrap.fill(SHORT[name], width)
            out += [(1000 + 100 * i + width, body), (2000 + 100 * i + width, f"Copyright (c) 2019, Jane Doe\nAll rights reserved.\n\n{body}\n"),
                    (3000 + 100 * i + width, "\n".join(f" * {x}".rstrip() for x in ["© 2001 X and Y", "Copyright Jane Q. Doe", "", *body.split("\n")]))]
    for i, file in enumerate(sorted(os.listdir(LONG_TEXTS))):
        with open(f"{LONG_TEXTS}/{file}", encoding="utf-8") as f:
            text = f.read()
        out += [(5000 + i, text), (5100 + i, " ".join(text.split("END OF TERMS")[0].split()).replace("https:", "http:") if "Copyright (C)" not in text else text.upper()),
                (5200 + i, text.split("END OF TERMS")[0])]
    return out


def test_known_cases(docs_of):
    got = {g.doc_id: g for g in scan(docs_of(rows()).selectExpr("*", "1 as license", "2 as key")).collect()}
    whole = {i: g.license for i, g in got.items()}
    assert [whole[i] for i in (1, 2, 3, 4, 5, 6, 7, 9, 13, 14, 15)] == [None, None, "Apache-2.0", "Apache-2.0", None, "MIT", "MIT", None, None, None, "MIT"]
    assert (got[5].n_lines, got[5].licenses) == (1, "Apache-2.0") and (got[8].n_paragraphs, got[8].licenses) == (2, "MIT")
    assert (got[11].n_lines, got[11].licenses) == (2 + 1, "Apache-2.0,MIT")
    assert all(whole[100 + i] is not None for i in range(len(LICENSES)))


def test_usual_files_are_found_whole(docs_of):
    got = {g.doc_id: g.license for g in scan(docs_of(usual())).collect()}
    names = sorted(SHORT)
    for i, license in got.items():
        if 1000 <= i < 4000:
            assert license == names[i % 1000 // 100], (i, license)
        elif i >= 5000:
            assert license == sorted(os.listdir(LONG_TEXTS))[i % 100][:-4], i
    assert (got[200], got[201], got[202]) == ("Apache-2.0", "MIT", None)


def test_a_table_of_ones_own_and_ties(docs_of, spark):
    mine = spark.createDataFrame([("B", "My own licence."), ("A", "my own LICENSE"), ("C", None), (None, "x license"), ("D", "")], "license string, text string")
    got = {g.doc_id: (g.license, g.licenses) for g in scan(docs_of([(1, "My own license!"), (2, "Released under the MIT License."), (3, "")]), mine).collect()}
    assert got == {1: ("A", "A,B"), 2: (None, ""), 3: (None, "")}
    assert scan(docs_of([(1, "My own license!")]), mine.limit(0)).first().license is None


def test_against_sql(docs_of):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows())
    want = con.sql(ORACLE).fetchall()
    got = [tuple(r) for r in scan(docs_of(rows())).select("doc_id", "license", "n_paragraphs", "n_lines", "licenses").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_empty_table(docs_of):
    assert scan(docs_of([])).collect() == []

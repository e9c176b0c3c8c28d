import hashlib
import re
import textwrap
import time

import pytest
from pyspark.sql import functions as F

from keyledger.llm import licences, secrets
from tests.llm import fixtures as fx


@pytest.fixture(scope="module")
def docs(spark):
    return fx.documents(spark).cache()


def brute_parts(text):
    out = []
    for kind, (_, pattern, group, least, _) in enumerate(secrets.KINDS):
        if kind == 2:
            pattern = r"[0-9a-f]+"
        out += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text, re.ASCII) if len(m.group(group)) >= least
                and (kind != 4 or all(re.search(c, m.group()) for c in "[A-Z] [a-z] [0-9]".split()))]
    return sorted(out)


def brute_secrets(text):
    parts = brute_parts(text)
    base = [p for p in parts if p[1] < secrets.BASE]
    weak = [w for w in parts if w[1] >= secrets.BASE and not any(b[:2] <= w[:2] and b[2] > w[0] for b in base)]
    near = lambda w: {secrets.KINDS[p[1]][4] for p in base + weak
                      if p[0] <= w[2] + secrets.SCOPE and p[2] >= w[0] - secrets.SCOPE}
    needs = {"login": lambda c: "secret" in c, "opaque": lambda c: bool(c & {"id", "place"}), "endpoint": lambda c: {"id", "secret"} <= c}
    linked = [w for w in weak if needs[secrets.KINDS[w[1]][0]](near(w))]
    show = lambda spans: ",".join(f"{secrets.KINDS[k][0]}:{a}:{b}" for a, k, b in sorted(spans))
    n = [sum(p[1] == k for p in base) for k in range(3)]
    return (*n, len(linked), hashlib.sha256(show(base).encode()).hexdigest(), show(base + linked))


def odd_secrets(spark):
    """Chains of parts at every distance from each other, and very many parts."""
    rows = [(200_000 + gap, "token=abcdef123" + " " * gap + "user=alice" + " " * (400 - gap) + "https://db.example.com/x "
             "Zm9vYmFyQmF6UXV4MTIz " + "é" * gap + " AKIA" + "Q" * 16) for gap in range(150, 260, 7)]
    rows += [(300_000, "user=bob " * 3000 + "token=abcdef1" + " login=zed" * 3000), (300_001, "password = 'x' api-key=1 apikey=abcdefg"),
             (300_002, "API_KEY\":\"abcdefgh\" passwd:  ======== AKIA1 AKIAabc " + "f" * 23 + " " + "F" * 30 + "g" + "0" * 24)]
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def test_secrets_against_brute_force(spark, docs):
    all_docs = docs.select("doc_id", "text").unionByName(odd_secrets(spark))
    got = sorted((tuple(r) for r in secrets.find_secrets(fx.with_extra(all_docs)).collect()), key=str)
    want = sorted(((i, *brute_secrets(t)) for i, t in fx.pairs(all_docs)), key=str)
    assert got == want
    assert sum(r[4] for r in want) > 50  # those within the scope of the one secret among 6000 logins, and the chains


def test_secrets_inside_long_parts(spark):
    """Opaque tokens and logins beside the middle of a part of thousands of code points."""
    token, path = "Zm9vYmFyQmF6UXV4MTIz", "p/" * 400
    rows = [(1, f"https://db.example.com/{path}?{token}&{path}~{token}&{path}"), (2, f"https://db.example.com/{path}?{token}&{path} " + "x " * 50 + token),
            (3, "user=" + "a1b2." * 500 + " token=abcdef123"), (4, "user=" + "a.b_" * 40 + " " * 100 + "token=abcdef123"),
            (5, "token=" + "ab" * 1500 + " user=bob " + " " * 300 + "login=zed"), (6, f"{token} " + "x " * 300 + "https://h.example/" + path)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r[0]: tuple(r)[1:] for r in secrets.find_secrets(docs).collect()}
    assert got == {i: brute_secrets(t) for i, t in rows}
    start = rows[0][1].index(token)
    assert f"opaque:{start}:{start + 20}" in got[1][-1].split(",")
    assert f"login:0:{5 + 160}" in got[4][-1].split(",")


def test_secrets_of_given_documents(spark):
    given = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r[0]: tuple(r)[1:] for r in secrets.find_secrets(given).collect()}
    want = {i: brute_secrets(t) for i, t in fx.pairs(given)}
    assert got == want and sum(r[0] for r in want.values()) > 0


def brute_licences(text):
    known = licences.known_sentences()
    sentences = licences.normalise(text)
    ids = [known[s] for s in sentences if s in known]
    left = [("id", i) for i in ids]
    for name, sequence in licences.RULES:
        at = 0
        while at + len(sequence) <= len(left):
            if left[at:at + len(sequence)] == [("id", s) for s in sequence]:
                left[at:at + len(sequence)] = [("rule", name)]
            at += 1
    found = [x for kind, x in left if kind == "rule"]
    return (len(sentences), len(ids), ",".join(ids), ",".join(sorted(set(found))), len(found), ",".join(x for kind, x in left if kind == "id"))


def full_text(*names):
    return "\n\n".join(licences.SENTENCES[n][0] for n in names)


def test_licences_against_brute_force(spark, docs):
    rows = [(400_000, full_text("MITperm", "MITnotice", "MITasis", "MITliable")), (400_001, full_text("BSDredist", "BSDsource", "BSDbinary")),
            (400_002, full_text("BSDredist", "BSDsource", "BSDbinary", "BSDendorse").upper()), (400_003, full_text("BSDbinary", "BSDredist")),
            (400_004, "prose first. " + full_text("GPL3redist") + " more prose.\n" + full_text("GPLwarranty") + "\nRELEASED under the MIT licence."),
            (400_005, "SPDX-License-Identifier: MIT"), (400_006, "Licensed under the Apache License, Version 2.0, or not.")]
    every = docs.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id bigint, text string"))
    got = sorted((tuple(r) for r in licences.scan_licences(fx.with_extra(every)).collect()), key=str)
    assert got == sorted(((i, *brute_licences(t)) for i, t in fx.pairs(every)), key=str)
    by_id = {r[0]: r[4] for r in got}
    assert by_id[400_000] == "MIT" and by_id[400_001] == "BSD-2-Clause" and by_id[400_002] == "BSD-3-Clause" and by_id[400_003] == ""
    assert by_id[400_004] == "GPL-3.0-or-later" and by_id[100024] == "Apache-2.0,MIT"


def test_wrapped_licences_and_spdx_tags(spark):
    wrap = lambda lead, *names, width=60: "\n".join(lead + line for n in names for line in [
        *textwrap.wrap(licences.SENTENCES[n][0], width), ""])
    mit, bsd2 = ("MITperm", "MITnotice", "MITasis", "MITliable"), ("BSDredist", "BSDsource", "BSDbinary")
    apache = ('/*\n * Licensed under the Apache License, Version 2.0 (the "License");\n * you may not use this file except in compliance'
              ' with the License.\n * You may obtain a copy of the License at\n *\n *     http://www.apache.org/licenses/LICENSE-2.0\n *\n'
              " * Unless required by applicable law or agreed to in writing, software\n * distributed under the License is distributed on"
              ' an "AS IS" BASIS,\n * WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.\n */')
    gpl2 = ("# This program is free software;\n# you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as"
            " published by\n# the Free Software Foundation; either version 2 of the License, or\n# (at your option) any later version.\n#\n"
            "# This program is distributed in the hope that it will be useful,\n# but WITHOUT ANY WARRANTY; without even the implied warranty")
    mpl = "This Source Code Form is subject to the terms of the Mozilla Public\n// License, v. 2.0. If a copy"
    want = {
        "MIT License\n\nCopyright (c) 2020 Someone\n\n" + wrap("", *mit): ("MIT", ",".join(mit), ""),
        wrap(" * ", *mit).replace("\n", "\r\n"): ("MIT", ",".join(mit), ""),
        wrap("# ", *bsd2, width=30): ("BSD-2-Clause", ",".join(bsd2), ""),
        apache: ("Apache-2.0", "Apache2ref,ApacheUse,ApacheAsis", ""),
        gpl2: ("GPL-2.0-or-later", "GPL2redist,GPL2version,GPLwarranty", ""),
        mpl: ("MPL-2.0", "MPL2ref", ""), mpl.replace("v. 2.0", "v. 1.1"): ("", "", ""),
        "// SPDX-License-Identifier: MIT\nint x;": ("MIT", "MITref", ""), "SPDX-License-Identifier: MIT": ("MIT", "MITref", ""),
        "/* SPDX-License-Identifier: GPL-2.0-only */": ("GPL-2.0", "GPL2ref", ""),
        "# SPDX-License-Identifier: Apache-2.0\n": ("Apache-2.0", "Apache2ref", ""),
        "prose ***\nReleased under the\n MIT License.": ("MIT", "MITref", ""),
        "Released under the\n\nMIT License.": ("", "", ""), "Not released under the MIT License.": ("", "", ""),
        "x" + " \n" * 200_000 + "Released under the MIT License": ("MIT", "MITref", ""),
    }
    docs = spark.createDataFrame(list(enumerate(want)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in licences.scan_licences(docs).collect()}
    for i, (text, expected) in enumerate(want.items()):
        assert (got[i].licences, got[i].sentence_ids, got[i].unmatched) == expected, text[:200]
        assert got[i].n_sentences == len(licences.normalise(text))


def test_no_python_and_no_shuffle_of_texts(spark, docs):
    plan = licences.scan_licences(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("InMemoryRelation")[0] and "Python" not in plan and "Arrow" not in plan
    plan = secrets.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_tables(spark, docs):
    none = docs.where(F.lit(False))
    assert licences.scan_licences(none).count() == 0 and secrets.find_secrets(none).count() == 0


def test_long_runs_of_punctuation_are_linear(spark):
    rows = [(1, "." * 1_000_000 + "a"), (2, ". " * 400_000), (3, ".;" * 300_000 + "\nReleased under the MIT License."), (4, "v." + " " * 500_000 + "x")]
    start = time.monotonic()
    got = {r.doc_id: (r.n_sentences, r.licences) for r in licences.scan_licences(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {1: (1, ""), 2: (0, ""), 3: (1, "MIT"), 4: (2, "")} and time.monotonic() - start < 30


def test_sql_finds_what_the_scans_find(spark, docs):
    """Wrapped sentences, SPDX tags and login values of any length, as the SQL sees them."""
    import duckdb
    import pandas as pd
    wrap = lambda lead, *names: "\n".join(lead + line for n in names for line in [*textwrap.wrap(licences.SENTENCES[n][0], 50), ""])
    texts = [wrap("", "MITperm", "MITnotice"), wrap(" * ", "BSDredist", "BSDsource", "BSDbinary").replace("\n", "\r\n"),
             "// SPDX-License-Identifier: Apache-2.0\nint x;", "SPDX-License-Identifier: MIT", "the Mozilla Public\n# License, v. 2.0.",
             "This Source Code Form is subject to the terms of the Mozilla Public\n// License, v. 2.0. If a copy", "Released under the\n\nMIT License.",
             "Released under the MIT License.\nReleased under the\nMIT License. Released under the MIT License.", "...!!! v. 2 v. 2.0 v.2", None, "",
             "user=" + "a.b_" * 40 + " " * 100 + "token=abcdef123", "login: " + "x" * 300 + " AKIA" + "A1" * 10]
    rows = [*enumerate(texts), *[(1000 + k, t) for k, (_, t) in enumerate(fx.pairs(docs.where("doc_id > 100000")))]]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]))
    for out, sql in ((licences.scan_licences(df), licences.ORACLE), (secrets.find_secrets(df), secrets.ORACLE)):
        res = con.execute(sql)
        at = [[d[0] for d in res.description].index(c) for c in out.columns]
        assert sorted(map(tuple, out.collect())) == sorted(tuple(r[i] for i in at) for r in res.fetchall())

from oracle import both

from tessera.llm import licenses as l

MIT = """The MIT License (MIT)

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.
"""


def test_query_against_sql(spark):
    got, want = both(spark, l.op2_license_scan, l.ORACLE_SQL["op2_license_scan"], "/root/testdata/sf0.01")
    assert got == want
    assert {r[1] for r in got} >= {"", "MIT", "Apache-2.0"}


def test_texts(spark):
    gpl = "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
    rows = [(1, MIT), (2, None), (3, ""), (4, "no end mark\nReleased under the MIT License.\nmore | text"), (5, "All rights reserved. Licensed under CC BY-NC 4.0."), (6, gpl), (7, "x " * 200_000 + "\nSPDX-License-Identifier: Apache-2.0"), (None, "All rights reserved"), (5, "All rights reserved. Licensed under CC BY-NC 4.0.")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as licenses", "2 as _ids")
    got = sorted(((r.doc_id or 0, r.licenses, r.unmatched) for r in l.license_scan(df).collect()))
    assert got[0] == (0, "Proprietary", "") and got[1] == (1, "MIT", "") and got[2:4] == [(2, "", ""), (3, "", "")]
    assert got[7] == (6, "", "gpl_hope") and got[8] == (7, "Apache-2.0", "")
    assert got[4] == (4, "MIT", "") and got[5] == got[6] == (5, "CC-BY-NC-4.0,Proprietary", "")
    assert l.license_scan(df.limit(0)).count() == 0


def test_rules_need_order(spark):
    s, r = {"a": "one licensed", "b": "two licensed"}, [("AB", ["a", "b"]), ("B", ["b"])]
    df = spark.createDataFrame([(1, "One licensed.\nTwo licensed."), (2, "Two licensed.\nOne licensed.")], "doc_id long, text string")
    assert sorted(tuple(x) for x in l.license_scan(df, sentences=s, rules=r).collect()) == [(1, "AB", 2, ""), (2, "B", 2, "a")]

from tessera.llm import licenses as l

HEADER = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
WIDE = HEADER.replace("software\n", "software ").replace("BASIS,\n", "BASIS, ").replace("permissions and\n", "permissions and ")


def test_wrapped_one_liners_and_the_apache_header(spark):
    texts = {
        "All rights\nreserved.": "Proprietary",
        "All  rights\treserved": "Proprietary",
        "This work is dedicated to the public\ndomain under CC0 1.0": "CC0-1.0",
        "This is free and unencumbered software released into the public\ndomain.": "Unlicense",
        HEADER: "Apache-2.0",
        WIDE: "Apache-2.0",
        "Copyright 2020 A. B.\n\n" + HEADER + "\ncode": "Apache-2.0",
        "".join(f"# {x}".rstrip() + "\n" for x in HEADER.splitlines()): "Apache-2.0",
        "".join(f" * {x}".rstrip() + "\n" for x in HEADER.splitlines()): "Apache-2.0",
        "all writes reserved": "",
    }
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.licenses for r in l.license_scan(df).collect()} == dict(enumerate(texts.values()))

import pytest

from tankwise.llm.license_texts import FOLDER
from tankwise.llm.licenses import ISC, MIT, known_texts, scan
from tests.llm.frames import docs, rows

CASES = [
    (1, MIT),
    (2, "Copyright (c) 2020 Somebody\n\n" + MIT.upper().replace("\n", "\r\n").replace("LICENSE", "LICENCE")),
    (3, "© 1999 Organisation\n" + ISC.replace(",", " ,").replace('"', "“")),
    (4, "Some text.\nLicenced under the Apache licence - version 2.0!\nMore text."),
    (5, MIT + "\nand one more sentence"),
    (6, "Licensed under CC BY-NC 4.0.\nReleased under the MIT License.\nreleased under the mit license"),
    (7, "It is said that it was released under the MIT License."),
    (8, "Copyright 2001 A\nAll rights reserved."),
    (8, "Released under the MIT License."),
]


def test_known_texts_and_notices(spark):
    got = {}
    for r in scan(docs(spark, CASES), known_texts(spark)).collect():
        got.setdefault(r["doc_id"], []).append((r["license"], r["notices"]))
    assert got[1] == got[2] == [("MIT", "")]
    assert got[3] == [("ISC", "")]
    assert got[4] == [(None, "Apache-2.0")]
    assert got[5] == got[7] == [(None, "")]
    assert got[6] == [(None, "CC-BY-NC-4.0,MIT")]
    assert sorted(got[8], key=repr) == [("MIT", "MIT"), (None, "")]


def test_odd_rows(spark):
    got = scan(docs(spark), known_texts(spark)).collect()
    assert len(got) == len(rows())
    assert all(r["license"] is None and r["notices"] == "" for r in got)
    assert len({r["canonical_sha256"] for r in got if r["doc_id"] in (5, 6, 7, 8)}) == 1
    assert scan(docs(spark, []), known_texts(spark)).collect() == []
    assert scan(docs(spark), known_texts(spark).limit(0)).count() == len(rows())


BSD_3 = """BSD 3-Clause License

Copyright (c) 2024, Somebody

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
%s
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
THIRD = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""


def test_whole_text_of_each_licence(spark):
    """As stored, and in capitals with other line ends under a copyright line."""
    texts = [(p.stem.partition("@")[0], p.read_text(encoding="utf-8")) for p in sorted(FOLDER.glob("*.txt"))]
    texts += [("BSD-3-Clause", BSD_3 % THIRD), ("BSD-2-Clause", (BSD_3 % "").replace("3-", "2-"))]
    texts += [("BSD-3-Clause", (BSD_3 % THIRD).partition("\n")[2])]
    texts += [(name, t[: t.index("END OF TERMS")]) for name, t in texts if "END OF TERMS" in t]
    texts += [(name, "Copyright 2020 Somebody\n\n" + t.upper().replace("\n", "\r\n")) for name, t in texts]
    assert {name for name, _ in texts} >= {
        "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1",
        "LGPL-3.0", "MPL-1.1", "MPL-2.0", "CC0-1.0", "CC-BY-SA-4.0", "GFDL-1.2", "GFDL-1.3", "Unlicense",
    }
    frame = docs(spark, [(k, t) for k, (_, t) in enumerate(texts)])
    got = {r["doc_id"]: (r["license"], r["notices"]) for r in scan(frame, known_texts(spark)).collect()}
    assert got == {k: (name, "") for k, (name, _) in enumerate(texts)}


@pytest.mark.parametrize("name", ["Apache-2.0", "GPL-3.0", "CC0-1.0"])
def test_more_than_a_licence_is_none(spark, name):
    text = (FOLDER / f"{name}.txt").read_text(encoding="utf-8") + "\nand one more sentence"
    assert [r["license"] for r in scan(docs(spark, [(1, text)]), known_texts(spark)).collect()] == [None]

"""Whole licence texts: the stored files, and short ones in their usual forms.

A file of ``license_texts`` is named after the licence it holds, with ``@`` and a word before the ending
where it holds a second wording or layout. Copyright lines are left out of canonical texts by line, so that
each text is given both as stored and with one line a paragraph."""

from __future__ import annotations

import re
from itertools import product
from pathlib import Path

FOLDER = Path(__file__).parent / "license_texts"

# Ends of the terms, addresses and links that differ from copy to copy.
END = "END OF TERMS AND CONDITIONS"
ADDRESS = re.compile(r"51 Franklin St(?:reet)?, Fifth Floor,\s+Boston,?\s+MA\s+02110-1301,?\s+USA")
ADDRESSES = [
    "51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA",
    "59 Temple Place, Suite 330, Boston, MA 02111-1307 USA",
]

# The clauses of the BSD licences and whom they name.
BSD_TERMS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted"
    " provided that the following conditions are met:"
)
BSD_CLAUSES = [
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the"
    " following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the"
    " following disclaimer in the documentation and/or other materials provided with the distribution.",
    "Neither the name of {name} nor the names of its contributors may be used to endorse or promote products"
    " derived from this software without specific prior written permission.",
]
BSD_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE {who} "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT'
    " LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE"
    " DISCLAIMED. IN NO EVENT SHALL THE {whom} BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,"
    " EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR"
    " SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF"
    " LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN"
    " ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
BSD_HOLDERS = [
    ("COPYRIGHT HOLDERS AND CONTRIBUTORS", "COPYRIGHT HOLDER OR CONTRIBUTORS"),
    ("COPYRIGHT HOLDERS AND CONTRIBUTORS", "COPYRIGHT HOLDERS OR CONTRIBUTORS"),
    ("REGENTS AND CONTRIBUTORS", "REGENTS OR CONTRIBUTORS"),
    ("AUTHOR AND CONTRIBUTORS", "AUTHOR OR CONTRIBUTORS"),
]
BSD_NAMES = ["the copyright holder", "the University", "the author"]


def bsd(clauses: int) -> list[str]:
    """The licence of two or three clauses, numbered or not, under its usual headings and for its usual holders."""
    headings = ["", f"BSD {clauses}-Clause License", f"The {clauses}-Clause BSD License", f"The BSD {clauses}-Clause License"]
    headings.append({2: 'BSD 2-Clause "Simplified" License', 3: 'BSD 3-Clause "New" or "Revised" License'}[clauses])
    made = []
    for heading, numbered, (who, whom), name in product(
        headings, (True, False), BSD_HOLDERS, BSD_NAMES if clauses == 3 else BSD_NAMES[:1]
    ):
        listed = [f"{k + 1}. {c}" if numbered else c for k, c in enumerate(BSD_CLAUSES[:clauses])]
        lines = [heading, BSD_TERMS, *listed, BSD_DISCLAIMER]
        made.append("\n".join(lines).format(name=name, who=who, whom=whom))
    return made


def _paragraphs(text: str) -> str:
    """One line a paragraph."""
    return "\n".join(" ".join(part.split()) for part in re.split(r"\n[ \t\f]*\n", text))


def usual_forms(text: str) -> list[str]:
    """A stored text with and without what follows its terms, with each address, with each kind of link, and
    with one line a paragraph."""
    forms = [text]
    if END in text:
        terms = text[: text.index(END)]
        forms += [terms + END, terms]
    forms += [ADDRESS.sub(address, form) for form in forms if ADDRESS.search(form) for address in ADDRESSES]
    forms += [form.replace("https://", "http://") for form in forms]
    forms += [form.replace("http://", "https://") for form in forms]
    forms += [_paragraphs(form) for form in forms]
    return list(dict.fromkeys(forms))


def whole_texts() -> list[tuple[str, str]]:
    """``license, text`` of the stored files and of the BSD licences, in all their forms."""
    found = []
    for path in sorted(FOLDER.glob("*.txt")):
        name = path.stem.partition("@")[0]
        found += [(name, form) for form in usual_forms(path.read_text(encoding="utf-8"))]
    for clauses in (2, 3):
        found += [(f"BSD-{clauses}-Clause", form) for form in bsd(clauses)]
    return found

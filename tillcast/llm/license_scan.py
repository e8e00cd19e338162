"""License scans by ordered signature rules.

A rule has a regular expression, a keyword that every match contains, a label and a priority.
One pass of an Aho-Corasick automaton over a text finds the keywords in it; only the rules of
those keywords run. Detections are resolved by rank: higher priority first, and a detection whose
interval lies within that of one already accepted is suppressed. Beside the rules, fixed phrases
are looked up in the sequence of the text's words.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.frames import keyed_texts, sliced

#: Phrases looked up word by word, and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

#: Label, keyword of the title, title (verbose, lower case), address or none. In the titles
#: ``_`` stands for white space or a hyphen and ``%`` for an optional "version" or "v".
LICENSES = """
AGPL-1.0 | affero | affero_general_public_licen[sc]e,?_%1(?:\\.0)? | -
AGPL-3.0 | affero | (?:gnu_)?affero_general_public_licen[sc]e,?_%3(?:\\.0)? | gnu.org/licenses/agpl(?:-3\\.0)?
AGPL | affero | (?:gnu_)?affero_general_public_licen[sc]e | -
LGPL-2.0 | general | (?:gnu_)?library_general_public_licen[sc]e(?:,?_%2(?:\\.0)?)? | -
LGPL-2.1 | lesser | (?:gnu_)?lesser_general_public_licen[sc]e,?_%2\\.1 | gnu.org/licenses/(?:old-licenses/)?lgpl-2\\.1
LGPL-3.0 | lesser | (?:gnu_)?lesser_general_public_licen[sc]e,?_%3(?:\\.0)? | gnu.org/licenses/lgpl(?:-3\\.0)?
LGPL | lesser | (?:gnu_)?lesser_general_public_licen[sc]e | -
GPL-1.0 | general | (?:gnu_)?general_public_licen[sc]e,?_%1(?:\\.0)? | gnu.org/licenses/(?:old-licenses/)?gpl-1\\.0
GPL-2.0 | general | (?:gnu_)?general_public_licen[sc]e,?_%2(?:\\.0)? | gnu.org/licenses/(?:old-licenses/)?gpl-2\\.0
GPL-3.0 | general | (?:gnu_)?general_public_licen[sc]e,?_%3(?:\\.0)? | gnu.org/licenses/gpl(?:-3\\.0)?
GPL | general | (?:gnu_)?general_public_licen[sc]e | gnu.org/copyleft/gpl
GFDL-1.3 | documentation | (?:gnu_)?free_documentation_licen[sc]e(?:,?_%1\\.3)? | gnu.org/licenses/fdl
Apache-1.1 | apache | apache(?:_software)?_licen[sc]e,?_%1\\.1 | apache.org/licenses/license-1\\.1
Apache-2.0 | apache | apache(?:_software)?_licen[sc]e,?_%2(?:\\.0)? | apache.org/licenses/license-2\\.0
Apache | apache | apache(?:_software)?_licen[sc]e | -
MIT | mit | (?:mit|expat|x11)_licen[sc]e | opensource.org/licenses?/mit
MIT-0 | mit | mit_no_attribution(?:_licen[sc]e)? | opensource.org/licenses?/mit-0
BSD-2-Clause | bsd | (?:2|two)_clause_bsd(?:_licen[sc]e)? | opensource.org/licenses?/bsd-2-clause
BSD-3-Clause | bsd | (?:(?:3|three)_clause_bsd|new_bsd|modified_bsd|revised_bsd)(?:_licen[sc]e)? | opensource.org/licenses?/bsd-3-clause
BSD-4-Clause | bsd | (?:(?:4|four)_clause_bsd|original_bsd)(?:_licen[sc]e)? | -
0BSD | bsd | zero_clause_bsd(?:_licen[sc]e)? | opensource.org/licenses?/0bsd
BSD | bsd | bsd_licen[sc]e | opensource.org/licenses?/bsd
ISC | isc | isc_licen[sc]e | opensource.org/licenses?/isc
MPL-1.0 | mozilla | mozilla_public_licen[sc]e,?_%1\\.0 | mozilla.org/mpl/1\\.0
MPL-1.1 | mozilla | mozilla_public_licen[sc]e,?_%1\\.1 | mozilla.org/mpl/1\\.1
MPL-2.0 | mozilla | mozilla_public_licen[sc]e,?_%2(?:\\.0)? | mozilla.org/(?:en-us/)?mpl/2\\.0
MPL | mozilla | mozilla_public_licen[sc]e | mozilla.org/mpl
EPL-1.0 | eclipse | eclipse_public_licen[sc]e,?_%1(?:\\.0)? | eclipse.org/legal/epl-v10
EPL-2.0 | eclipse | eclipse_public_licen[sc]e,?_%2(?:\\.0)? | eclipse.org/legal/epl-2\\.0
EDL-1.0 | eclipse | eclipse_distribution_licen[sc]e(?:,?_%1(?:\\.0)?)? | eclipse.org/org/documents/edl-v10
CDDL-1.0 | common | common_development_and_distribution_licen[sc]e(?:,?_%1(?:\\.0)?)? | opensource.org/licenses?/cddl-1\\.0
CPL-1.0 | common | common_public_licen[sc]e(?:,?_%1(?:\\.0)?)? | opensource.org/licenses?/cpl1\\.0
EUPL-1.1 | european | european_union_public_licen[sc]e,?_%1\\.1 | -
EUPL-1.2 | european | european_union_public_licen[sc]e(?:,?_%1\\.2)? | joinup.ec.europa.eu/[^\\s]{0,60}eupl
Artistic-1.0 | artistic | artistic_licen[sc]e,?_%1(?:\\.0)? | opensource.org/licenses?/artistic-1\\.0
Artistic-2.0 | artistic | artistic_licen[sc]e(?:,?_%2(?:\\.0)?)? | opensource.org/licenses?/artistic-2\\.0
Zlib | zlib | zlib(?:/libpng)?_licen[sc]e | opensource.org/licenses?/zlib
libpng | libpng | libpng_licen[sc]e | -
BSL-1.0 | boost | boost_software_licen[sc]e(?:,?_%1(?:\\.0)?)? | boost.org/license_1_0
BUSL-1.1 | business | business_source_licen[sc]e(?:,?_%1\\.1)? | mariadb.com/bsl11
SSPL-1.0 | server | server_side_public_licen[sc]e(?:,?_%1)? | mongodb.com/licensing/server-side-public-license
Elastic-2.0 | elastic | elastic_licen[sc]e(?:,?_%2(?:\\.0)?)? | elastic.co/licensing/elastic-license
Unlicense | unlicense | the_unlicense | unlicense.org
WTFPL | want | do_what_the_fuck_you_want_to_public_licen[sc]e | wtfpl.net
PSF-2.0 | python | python_software_foundation_licen[sc]e(?:,?_%2)? | python.org/psf/license
PHP-3.01 | php | php_licen[sc]e(?:,?_%3\\.01)? | php.net/license/3_01
Ruby | ruby | ruby_licen[sc]e | -
PostgreSQL | postgresql | postgresql_licen[sc]e | opensource.org/licenses?/postgresql
OFL-1.1 | open | (?:sil_)?open_font_licen[sc]e(?:,?_%1\\.1)? | scripts.sil.org/ofl
OSL-3.0 | open | open_software_licen[sc]e(?:,?_%3(?:\\.0)?)? | opensource.org/licenses?/osl-3\\.0
AFL-3.0 | academic | academic_free_licen[sc]e(?:,?_%3(?:\\.0)?)? | opensource.org/licenses?/afl-3\\.0
NCSA | illinois | university_of_illinois/ncsa_open_source_licen[sc]e | opensource.org/licenses?/ncsa
MS-PL | microsoft | microsoft_public_licen[sc]e | opensource.org/licenses?/ms-pl
MS-RL | microsoft | microsoft_reciprocal_licen[sc]e | opensource.org/licenses?/ms-rl
IPL-1.0 | ibm | ibm_public_licen[sc]e(?:,?_%1(?:\\.0)?)? | -
APSL-2.0 | apple | apple_public_source_licen[sc]e(?:,?_%2(?:\\.0)?)? | opensource.apple.com/apsl
CECILL-2.1 | cecill | cecill(?:_free_software)?_licen[sc]e(?:,?_%2\\.1)? | cecill.info/licences
MulanPSL-2.0 | mulan | mulan_permissive_software_licen[sc]e(?:,?_%2)? | license.coscl.org.cn/mulanpsl2
UPL-1.0 | universal | universal_permissive_licen[sc]e(?:,?_%1(?:\\.0)?)? | opensource.org/licenses?/upl
Vim | vim | vim_licen[sc]e | -
CC0-1.0 | cc0 | cc0(?:_%?1\\.0)?(?:_universal)? | creativecommons.org/publicdomain/zero
CC-BY-1.0 | attribution | creative_commons_attribution_%1\\.0 | creativecommons.org/licenses/by/1\\.0
CC-BY-2.0 | attribution | creative_commons_attribution_%2\\.0 | creativecommons.org/licenses/by/2\\.0
CC-BY-3.0 | attribution | creative_commons_attribution_%3\\.0 | creativecommons.org/licenses/by/3\\.0
CC-BY-4.0 | attribution | creative_commons_attribution_%4\\.0 | creativecommons.org/licenses/by/4\\.0
CC-BY-SA | sharealike | (?:creative_commons_)?attribution_sharealike(?:_%[1-4]\\.[05])? | creativecommons.org/licenses/by-sa
CC-BY-ND | noderiv | (?:creative_commons_)?attribution_no_?deriv(?:s|atives)(?:_%[1-4]\\.[05])? | creativecommons.org/licenses/by-nd
CC-BY-NC | noncommercial | (?:creative_commons_)?attribution_noncommercial(?:_%[1-4]\\.[05])? | creativecommons.org/licenses/by-nc/
CC-BY-NC-SA | noncommercial | (?:creative_commons_)?attribution_noncommercial_sharealike(?:_%[1-4]\\.[05])? | creativecommons.org/licenses/by-nc-sa
CC-BY-NC-ND | noncommercial | (?:creative_commons_)?attribution_noncommercial_no_?deriv(?:s|atives)(?:_%[1-4]\\.[05])? | creativecommons.org/licenses/by-nc-nd
ODbL-1.0 | open | open_(?:data(?:_commons)?_open_)?database_licen[sc]e(?:,?_%1(?:\\.0)?)? | opendatacommons.org/licenses/odbl
ODC-By-1.0 | attribution | open_data_commons_attribution_licen[sc]e | opendatacommons.org/licenses/by
PDDL-1.0 | public | public_domain_dedication_and_licen[sc]e | opendatacommons.org/licenses/pddl
CDLA-Permissive | community | community_data_licen[sc]e_agreement_permissive | cdla.io/permissive
CDLA-Sharing | community | community_data_licen[sc]e_agreement_sharing | cdla.io/sharing
OGL | open | open_government_licen[sc]e(?:,?_%[1-3](?:\\.0)?)? | nationalarchives.gov.uk/doc/open-government-licence
"""

#: Label, keyword, regular expression, priority: notices that name no license.
NOTICES = [
    ("copyright", "copyright", r"\bcopyright\s+(?:\(c\)|©)?\s*(?:19|20)\d\d", 30),
    ("copyright", "©", r"©\s*(?:19|20)\d\d", 30),
    ("public-domain", "public", r"\b(?:in|into|to)\s+the\s+public\s+domain\b", 40),
    ("reserved", "rights", r"\b(?:all|some|no)\s+rights\s+reserved\b", 40),
    ("no-warranty", "warranty", r"\bwithout\s+(?:any\s+)?warranty\s+of\s+any\s+kind\b", 20),
    ("no-warranty", "warrant", r"\bwithout\s+warranties\s+or\s+conditions\b", 20),
    ("no-warranty", "merchantability", r"\bmerchantability\s+(?:and|or)\s+fitness\b", 20),
    ("permission", "permission", r"\bpermission\s+is\s+hereby\s+granted,?\s+free\b", 35),
    ("redistribution", "redistribution", r"\bredistributions?\s+and\s+use\s+in\s+source\b", 35),
    ("proprietary", "proprietary", r"\bproprietary\s+and\s+confidential\b", 35),
]


@dataclass(frozen=True)
class Rule:
    name: str
    label: str
    keyword: str
    pattern: str
    priority: int


def rules() -> list[Rule]:
    """All rules in order: for each license its tag, grant, address, file name and title."""
    out = []
    for line in LICENSES.strip().splitlines():
        label, keyword, title, address = (x.strip() for x in line.split(" | "))
        title = title.replace("_%", r"[\s,-]+(?:version\s+|ver\.?\s+|v\.?\s*)?")
        title = title.replace("%", "").replace("_", r"[\s-]+")
        spdx = re.escape(label.lower())
        end = r"(?![\w-]|\.\d)"
        out.append(Rule(f"{label}/tag", label, "spdx", rf"spdx-license-identifier:\s*{spdx}(?:-only|-or-later|\+)?{end}", 100))
        given = r"(?:licen[sc]ed|released|distributed|available|provided|published|covered)"
        terms = r"(?:(?:terms|conditions)\s+of\s+)?(?:an?\s+|the\s+)?"
        out.append(Rule(f"{label}/grant", label, keyword, rf"\b{given}\s+under\s+(?:the\s+)?{terms}{title}{end}", 80))
        if address != "-":
            where = address.replace(".org", r"\.org").replace(".com", r"\.com")
            out.append(Rule(f"{label}/address", label, address.split("/")[0], rf"https?://(?:www\.)?{where}", 70))
        if "-" in label or any(c.isdigit() for c in label):
            out.append(Rule(f"{label}/name", label, "licen", rf"\blicen[sc]e[sd]?\s*[:=(]\s*[\"']?{spdx}{end}", 60))
        out.append(Rule(f"{label}/title", label, keyword, rf"\b{title}{end}", 50))
    for k, (label, keyword, pattern, priority) in enumerate(NOTICES):
        out.append(Rule(f"notice/{k}", label, keyword, pattern, priority))
    return out


class Scanner:
    """Compiled rules behind their keywords."""

    def __init__(self):
        import ahocorasick

        self._rules: dict[str, list] = {}
        for order, rule in enumerate(rules()):
            compiled = (order, rule, re.compile(rule.pattern))
            self._rules.setdefault(rule.keyword, []).append(compiled)
        self._keywords = ahocorasick.Automaton()
        for keyword in self._rules:
            self._keywords.add_word(keyword, keyword)
        self._keywords.make_automaton()

    def detections(self, lowered: str) -> list[tuple[str, str, int, int, int]]:
        """Accepted ``rule, label, priority, start, end`` (code points) of a lower-case text."""
        found = []
        for keyword in {k for _, k in self._keywords.iter(lowered)}:
            for order, rule, regex in self._rules[keyword]:
                for m in regex.finditer(lowered):
                    found.append((-rule.priority, order, m.start(), m.end(), rule))
        return resolve(found)


def lower_ascii(text: str) -> str:
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def resolve(found: list[tuple]) -> list[tuple[str, str, int, int, int]]:
    """Suppress what lies within an interval of higher rank: priority, then width, then order.

    Each priority is swept from the left, widest first, against what is accepted so far.
    """
    starts: list[int] = []
    furthest: list[int] = []  # the largest end up to each start
    kept = []
    for priority in sorted({f[0] for f in found}):
        level, reach = [], -1
        some = [f for f in found if f[0] == priority]
        for f in sorted(some, key=lambda f: (f[2], -f[3], f[1])):
            at = bisect_right(starts, f[2])
            if f[3] <= max(reach, furthest[at - 1] if at else -1):
                continue
            reach = f[3]
            level.append(f)
        kept += level
        starts, furthest, reach = [], [], -1
        for f in sorted(kept, key=lambda f: f[2]):
            reach = max(reach, f[3])
            starts.append(f[2])
            furthest.append(reach)
    kept.sort(key=lambda f: (f[2], f[3], f[1]))
    return [(f[4].name, f[4].label, -f[0], f[2], f[3]) for f in kept]


def _table() -> bytes:
    keep = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(0x80, 0x100))
    return bytes(b if b in keep else 0x20 for b in range(256))


_WORD_BYTES = _table()
_PLACES = [(f" {phrase} ".encode(), label) for phrase, label in PHRASES.items()]


def phrase_places(lowered: str) -> tuple[int, list[tuple[str, int]]]:
    """Number of words, and label and first word of every place of a phrase."""
    raw = lowered.encode("utf-8", "surrogatepass").translate(_WORD_BYTES)
    words = raw.split()
    line = b" " + b" ".join(words) + b" "
    places = []
    for phrase, label in _PLACES:
        at, word, last = line.find(phrase), 0, 0
        while at >= 0:
            word += line.count(b" ", last, at)
            places.append((label, word))
            last = at
            at = line.find(phrase, at + 1)
    return len(words), sorted(places, key=lambda p: p[1])


_PLACE = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))
_FOUND = pa.list_(
    pa.struct(
        [
            ("rule", pa.string()),
            ("label", pa.string()),
            ("priority", pa.int32()),
            ("start", pa.int64()),
            ("end", pa.int64()),
        ]
    )
)


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scanner = Scanner()
    place_names, found_names = ("label", "word"), ("rule", "label", "priority", "start", "end")
    for batch in sliced(batches):
        n_words, places, found = [], [], []
        for text in batch.column(2).to_pylist():
            lowered = lower_ascii(text)
            n, at = phrase_places(lowered)
            n_words.append(n)
            places.append([dict(zip(place_names, p)) for p in at])
            found.append([dict(zip(found_names, d)) for d in scanner.detections(lowered)])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(n_words, pa.int64()),
                pa.array(places, _PLACE),
                pa.array(found, _FOUND),
            ],
            ["row", "id", "n_words", "places", "detections"],
        )


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each input row: ``row, id, n_words, places, detections``.

    ``places`` has the label and first word of every place of a phrase; ``detections`` the rule,
    label, priority and code points of what the rules found and did not suppress. A null text is
    an empty one and has neither. Rows given twice are scanned twice; ids may be null.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    return keyed_texts(docs, id_col, text_col).mapInArrow(
        _scanned,
        f"row bigint, id {kind}, n_words bigint, places array<struct<label: string, word: "
        "bigint>>, detections array<struct<rule: string, label: string, priority: int, "
        "start: bigint, end: bigint>>",
    )


def summary(scanned: DataFrame) -> DataFrame:
    """Counts and labels of each scanned row, and a score.

    The score is the chance that one of its findings is right, if a phrase is right half of the
    time and a rule of priority p in p of 101 cases.
    """
    base, found = F.col("places"), F.col("detections")
    words = F.transform(base, lambda p: p["word"])
    labels = F.transform(base, lambda p: p["label"])
    more = F.transform(found, lambda d: d["label"])
    wrong = F.concat(
        F.transform(base, lambda p: F.lit(0.5)),
        F.transform(found, lambda d: 1 - d["priority"] / F.lit(101.0)),
    )

    def joined(c):
        return F.array_join(F.array_sort(F.array_distinct(c)), ",")

    return scanned.select(
        F.col("id").alias("doc_id"),
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(words).alias("first_word"),
        F.array_max(words).alias("last_word"),
        joined(labels).alias("base_labels"),
        joined(F.concat(labels, more)).alias("labels"),
        (1 - F.aggregate(wrong, F.lit(1.0), lambda a, x: a * x)).alias("score"),
    )

"""License scan: ordered signature rules with keyword prefilter, priorities and
interval-containment suppression.

A rule is a regular expression with a label, a priority, a score and keywords, at
least one of which is in every possible match: as a whole run of letters (so
GPLv3 has the keyword gplv), or, where the expression does not end at a run's
ends, as any part of the text.  Runs of the whole batch are hashed at once; only
texts that hold a rule's keyword are decoded, and only the rules of the keywords
found run on them.  SPDX rules run on each member of a tag's whole expression.  A detection that lies inside
another of higher rank (priority, then length, then place, then rule order) is
suppressed; containment is transitive, so one sweep decides all of them.

Base phrases are found on the words themselves and are never suppressed.

Defined results: null or empty text has no words and no labels (empty strings,
score 0, null places).  Rows are judged one by one, so repeated rows and ties
give repeated rows; an empty table gives an empty table; other columns of the
input are not carried.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewater.llm.common import id_and_text, map_batches
from tidewater.llm.text import ALNUM, LOWER, buffers, chunks, spans, word_hashes

SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double, n_detections long")

#: Phrase words -> label.
BASE_PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)
BASE_SCORE = 0.6

LETTERS = np.zeros(256, bool)
LETTERS[97:123] = True

# a gap between words: bounded, so that no expression scans far
_GAP = r"[\W_]{1,6}"


def _words(name: str) -> str:
    """A name as an expression: its words with short gaps, 'license' in both spellings."""
    return _GAP.join(re.escape(w).replace("license", "licen[cs]e") for w in name.split())


def _version(v: str) -> str:
    """Version 2.0 also reads as 2; a 'v' or 'version' may stand before it."""
    major, _, minor = v.partition(".")
    tail = rf"(?:\.{minor})?" if minor == "0" else rf"\.{re.escape(minor)}" if minor else ""
    return rf"(?:[\W_]{{0,4}}(?:version|ver|v)?[\W_]{{0,3}}{major}{tail})(?![0-9])"


#: license id stem; keyword; names; versions ('' for none); addresses
FAMILIES = (
    ("apache", "apache", ("apache license", "apache software license", "apache public license"), ("1.0", "1.1", "2.0"), (r"apache\.org/licenses/license-{v}",)),
    ("gpl", "gpl", ("gpl", "gnu gpl"), ("1.0", "2.0", "3.0"), (r"gnu\.org/licenses/(?:old-licenses/)?gpl-{v}",)),
    ("gpl", "general", ("gnu general public license",), ("1.0", "2.0", "3.0"), ()),
    ("lgpl", "lgpl", ("lgpl", "gnu lgpl"), ("2.0", "2.1", "3.0"), (r"gnu\.org/licenses/(?:old-licenses/)?lgpl-{v}",)),
    ("lgpl", "lesser", ("gnu lesser general public license", "lesser general public license"), ("2.1", "3.0"), ()),
    ("lgpl", "library", ("gnu library general public license",), ("2.0",), ()),
    ("agpl", "agpl", ("agpl", "gnu agpl"), ("1.0", "3.0"), (r"gnu\.org/licenses/agpl-{v}",)),
    ("agpl", "affero", ("gnu affero general public license", "affero general public license"), ("1.0", "3.0"), ()),
    ("gfdl", "documentation", ("gnu free documentation license",), ("1.1", "1.2", "1.3"), (r"gnu\.org/licenses/(?:old-licenses/)?fdl-{v}",)),
    ("mpl", "mozilla", ("mozilla public license",), ("1.0", "1.1", "2.0"), (r"mozilla\.org/mpl/{v}",)),
    ("epl", "eclipse", ("eclipse public license",), ("1.0", "2.0"), (r"eclipse\.org/legal/epl-{v}",)),
    ("cddl", "cddl", ("cddl", "common development and distribution license cddl"), ("1.0", "1.1"), ()),
    ("cddl", "development", ("common development and distribution license",), ("1.0", "1.1"), ()),
    ("eupl", "eupl", ("eupl",), ("1.0", "1.1", "1.2"), ()),
    ("eupl", "european", ("european union public license",), ("1.0", "1.1", "1.2"), ()),
    ("osl", "open", ("open software license",), ("1.0", "2.0", "2.1", "3.0"), ()),
    ("afl", "academic", ("academic free license",), ("1.1", "2.0", "2.1", "3.0"), ()),
    ("artistic", "artistic", ("artistic license",), ("1.0", "2.0"), ()),
    ("cpl", "common", ("common public license",), ("1.0",), ()),
    ("ipl", "ibm", ("ibm public license",), ("1.0",), ()),
    ("lppl", "latex", ("latex project public license",), ("1.0", "1.1", "1.2", "1.3"), ()),
    ("ofl", "sil", ("sil open font license",), ("1.0", "1.1"), (r"scripts\.sil\.org/ofl",)),
    ("zpl", "zope", ("zope public license",), ("1.1", "2.0", "2.1"), ()),
    ("php", "php", ("php license",), ("3.0", "3.01"), ()),
    ("psf", "python", ("python software foundation license", "python license"), ("2.0", ""), ()),
    ("bsl", "boost", ("boost software license",), ("1.0",), (r"boost\.org/license_{v}",)),
    ("busl", "business", ("business source license",), ("1.0", "1.1"), ()),
    ("sspl", "server", ("server side public license",), ("1.0", ""), ()),
    ("odbl", "database", ("open database license", "open data commons open database license"), ("1.0", ""), (r"opendatacommons\.org/licenses/odbl",)),
    ("pddl", "dedication", ("public domain dedication and license",), ("1.0", ""), (r"opendatacommons\.org/licenses/pddl",)),
    ("odc-by", "commons", ("open data commons attribution license",), ("1.0", ""), (r"opendatacommons\.org/licenses/by",)),
    ("ecl", "educational", ("educational community license",), ("1.0", "2.0"), ()),
    ("upl", "universal", ("universal permissive license",), ("1.0",), ()),
    ("ms-pl", "microsoft", ("microsoft public license",), ("",), ()),
    ("ms-rl", "microsoft", ("microsoft reciprocal license",), ("",), ()),
    ("mit", "mit", ("mit license", "mit licence", "expat license"), ("",), (r"opensource\.org/licenses/mit",)),
    ("isc", "isc", ("isc license",), ("",), (r"opensource\.org/licenses/isc",)),
    ("zlib", "zlib", ("zlib license", "zlib libpng license"), ("",), ()),
    ("unlicense", "unlicense", ("the unlicense", "unlicense"), ("",), (r"unlicense\.org",)),
    ("wtfpl", "wtfpl", ("wtfpl",), ("",), (r"wtfpl\.net",)),
    ("beerware", "beerware", ("beerware license", "beerware"), ("",), ()),
    ("ncsa", "ncsa", ("university of illinois ncsa open source license", "ncsa license"), ("",), ()),
    ("openssl", "openssl", ("openssl license",), ("",), ()),
    ("postgresql", "postgresql", ("postgresql license",), ("",), ()),
    ("bsd", "bsd", ("bsd license", "bsd style license", "berkeley software distribution license"), ("",), ()),
    ("bsd-0-clause", "bsd", ("zero clause bsd", "0 clause bsd", "0bsd"), ("",), ()),
    ("bsd-2-clause", "bsd", ("2 clause bsd", "two clause bsd", "bsd 2 clause", "simplified bsd", "freebsd license"), ("",), (r"opensource\.org/licenses/bsd-2-clause",)),
    ("bsd-3-clause", "bsd", ("3 clause bsd", "three clause bsd", "bsd 3 clause", "modified bsd", "new bsd", "revised bsd"), ("",), (r"opensource\.org/licenses/bsd-3-clause",)),
    ("bsd-4-clause", "bsd", ("4 clause bsd", "four clause bsd", "bsd 4 clause", "original bsd"), ("",), ()),
    ("cc0", "cc0", ("cc0",), ("1.0", ""), (r"creativecommons\.org/publicdomain/zero",)),
    ("public-domain", "public", ("released into the public domain", "dedicated to the public domain", "in the public domain"), ("",), (r"creativecommons\.org/publicdomain/mark",)),
)
#: creative commons elements, in words and as a code
CREATIVE = (
    ("by", "attribution"),
    ("by-sa", "attribution sharealike"),
    ("by-nd", "attribution noderivatives"),
    ("by-nc", "attribution noncommercial"),
    ("by-nc-sa", "attribution noncommercial sharealike"),
    ("by-nc-nd", "attribution noncommercial noderivatives"),
)
CREATIVE_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
#: label; keyword; hand-written expression
NOTICES = (
    ("copyright", "copyright", r"copyright[\W_]{1,6}(?:\(c\)[\W_]{0,4})?(?:19|20)[0-9]{2}"),
    ("copyright", "copyright", r"\(c\)[\W_]{0,4}copyright"),
    ("copyright", "copyrighted", r"copyrighted[\W_]{1,4}(?:material|work|content)"),
    ("reserved", "reserved", r"some[\W_]{1,6}rights[\W_]{1,6}reserved"),
    ("reserved", "rights", r"no[\W_]{1,6}part[\W_]{1,6}of[\W_]{1,6}this[\W_]{1,6}\w{1,20}[\W_]{1,6}may[\W_]{1,6}be[\W_]{1,6}reproduced"),
    ("mit", "granted", r"permission[\W_]{1,6}is[\W_]{1,6}hereby[\W_]{1,6}granted,?[\W_]{1,6}free[\W_]{1,6}of[\W_]{1,6}charge"),
    ("isc", "permission", r"permission[\W_]{1,6}to[\W_]{1,6}use,?[\W_]{1,6}copy,?[\W_]{1,6}modify,?[\W_]{1,6}and(?:/or)?[\W_]{1,6}distribute"),
    ("bsd", "redistribution", r"redistribution[\W_]{1,6}and[\W_]{1,6}use[\W_]{1,6}in[\W_]{1,6}source[\W_]{1,6}and[\W_]{1,6}binary[\W_]{1,6}forms"),
    ("warranty", "warranty", r"without[\W_]{1,6}(?:any[\W_]{1,6})?warranty[\W_]{1,6}of[\W_]{1,6}any[\W_]{1,6}kind"),
    ("warranty", "warranties", r"without[\W_]{1,6}warranties[\W_]{1,6}or[\W_]{1,6}conditions"),
    ("zlib", "misrepresented", r"origin[\W_]{1,6}of[\W_]{1,6}this[\W_]{1,6}software[\W_]{1,6}must[\W_]{1,6}not[\W_]{1,6}be[\W_]{1,6}misrepresented"),
    ("boost", "boost", r"boost[\W_]{1,6}software[\W_]{1,6}license"),
    ("gpl", "redistribute", r"redistribute[\W_]{1,6}it[\W_]{1,6}and/or[\W_]{1,6}modify[\W_]{1,6}it[\W_]{1,6}under[\W_]{1,6}the[\W_]{1,6}terms[\W_]{1,6}of[\W_]{1,6}the[\W_]{1,6}gnu"),
    ("proprietary", "proprietary", r"proprietary[\W_]{1,6}and[\W_]{1,6}confidential"),
    ("proprietary", "confidential", r"strictly[\W_]{1,6}confidential"),
    ("proprietary", "unauthorized", r"unauthorized[\W_]{1,6}(?:copying|use|distribution|reproduction)"),
    ("proprietary", "agreement", r"end[\W_]{1,6}user[\W_]{1,6}licen[cs]e[\W_]{1,6}agreement"),
    ("patent", "patent", r"grant[\W_]{1,6}of[\W_]{1,6}patent[\W_]{1,6}licen[cs]e"),
    ("llvm", "llvm", r"llvm[\W_]{1,4}exception"),
    ("classpath", "classpath", r"classpath[\W_]{1,4}exception"),
)


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    score: float
    keyword: str
    pattern: str
    others: tuple[str, ...] = ()     # further keywords: every match holds one of them or the first
    part: bool = True                # the keyword may be a part of a longer run of letters
    spdx: bool = False               # the expression is searched in the expressions of SPDX tags


#: a tag and its expression: members joined by operators, with or without brackets
_MEMBER = r"[(\s]*[a-z0-9.+\-]+(?:\s{0,4}\))*"
SPDX = re.compile(rf"spdx[\W_]{{0,2}}license[\W_]{{0,2}}identifier[\W_]{{1,4}}({_MEMBER}(?:\s{{1,4}}(?:and|or|with)\b{_MEMBER})*)")


def _runs_of(name: str, keyword: str, versioned: bool) -> list[str]:
    """Runs of letters, one of which is in every text that the name stands for."""
    runs = re.findall("[a-z]+", name)
    wanted = re.findall("[a-z]+", keyword)[0]
    run = wanted if wanted in runs else max((r for r in runs if r != "licence"), key=lambda r: (r != "license", len(r)))
    out = [run] + [run + glue for glue in ("v", "ver", "version") if versioned and name.endswith(run)]
    return out + [r.replace("license", "licence") for r in out if "license" in r]


def rule_set() -> tuple[Rule, ...]:
    """All rules, in order: tags, addresses, grants, versioned names, bare names, notices."""
    out: list[Rule] = []
    grant = rf"(?:licen[cs]ed|released|distributed|available|provided){_GAP}under{_GAP}(?:the{_GAP})?(?:terms{_GAP}of{_GAP}(?:the{_GAP})?)?"
    for stem, keyword, names, versions, addresses in FAMILIES:
        def named(label: str, priority: int, score: float, pattern: str, of: tuple[str, ...], versioned: bool) -> Rule:
            runs = dict.fromkeys(r for n in of for r in _runs_of(n, keyword, versioned))
            return Rule(label, priority, score, next(iter(runs)), pattern, tuple(runs)[1:], part=False)
        for v in versions:
            label = f"{stem}-{v}" if v else stem
            tag = re.escape(label).replace(r"\.0", r"(?:\.0)?")
            out.append(Rule(label, 100, 1.0, "spdx", rf"(?<![\w.+\-]){tag}(?:-only|-or-later|\+)?(?![\w.]*[a-z0-9])", spdx=True))
            out += [Rule(label, 90, 0.95, a.split(r"\.")[0].rsplit("/", 1)[-1], a.format(v=re.escape(v) if v else "")) for a in addresses]
            name = "(?:" + "|".join(_words(n) for n in names) + ")"
            versioned = rf"(?<!\w){name}{_version(v)}" if v else rf"(?<!\w){name}(?!\w)"
            out.append(named(label, 80, 0.9, grant + versioned.removeprefix(r"(?<!\w)"), names, bool(v)))
            out.append(named(label, 70 if v else 60, 0.85 if v else 0.8, versioned, names, bool(v)))
        if "" not in versions:
            out += [named(stem, 50, 0.75, rf"(?<!\w){_words(n)}(?!\w)", (n,), False) for n in names]
    for code, words in CREATIVE:
        short = rf"(?<!\w)cc[\W_]{{1,3}}" + code.replace("-", r"[\W_]{1,3}")
        long = rf"creative{_GAP}commons{_GAP}" + _words(words).replace("sharealike", r"share[\W_]?alike").replace("noderivatives", r"no[\W_]?deriv(?:ative)?s?(?:ives)?").replace("noncommercial", r"non[\W_]?commercial")
        for v in CREATIVE_VERSIONS:
            n = len(code)
            out.append(Rule(f"cc-{code}-{v}", 85 + n, 0.95, "cc", short + r"[\W_]{1,3}" + re.escape(v) + r"(?![0-9])", part=False))
            out.append(Rule(f"cc-{code}-{v}", 85 + n, 0.95, "creativecommons", rf"creativecommons\.org/licenses/{code}/{re.escape(v)}"))
            out.append(Rule(f"cc-{code}-{v}", 85 + n, 0.95, "creative", long + rf"[\w\W]{{0,20}}?{re.escape(v)}(?![0-9])"))
        out.append(Rule(f"cc-{code}", 60 + len(code), 0.8, "cc", short + r"(?!\w)", part=False))
        out.append(Rule(f"cc-{code}", 60 + len(code), 0.8, "creative", long + r"(?!\w)"))
    out += [Rule(label, 40, 0.5, keyword, pattern) for label, keyword, pattern in NOTICES]
    return tuple(out)


class Scanner:
    """Compiled rules; one for each worker process."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = [(r, re.compile(r.pattern)) for r in rules]
        self.by_keyword: dict[int, list[int]] = {}
        self.by_part: dict[bytes, list[int]] = {}
        for i, r in enumerate(rules):
            for k in (r.keyword, *r.others):
                if r.part:
                    self.by_part.setdefault(k.encode(), []).append(i)
                else:
                    self.by_keyword.setdefault(int(_hash_of(k)[0]), []).append(i)
        self.keywords = np.sort(np.array(list(self.by_keyword), np.uint64))
        self.maybe = np.zeros(1 << 16, bool)          # first look at the low bits only
        self.maybe[(self.keywords & np.uint64(0xFFFF)).astype(np.int64)] = True
        self.base = [(_hash_of(words), label) for words, label in BASE_PHRASES]

    def keywords_at(self, hashes: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(self.maybe[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
        return at[np.isin(hashes[at], self.keywords)]

    def gate(self, low: np.ndarray, offsets: np.ndarray) -> dict[int, set[int]]:
        """Document -> rules that may match in it."""
        starts, ends, word0 = spans(low, offsets, LETTERS)
        h = word_hashes(low, starts, ends)
        keyed = self.keywords_at(h)
        out: dict[int, set[int]] = {}
        for d, k in zip((np.searchsorted(word0, keyed, "right") - 1).tolist(), h[keyed].tolist()):
            out.setdefault(d, set()).update(self.by_keyword[k])
        text = low[:offsets[-1]].tobytes()
        for part, rules in self.by_part.items():
            at = text.find(part, int(offsets[0]))
            while at >= 0:
                d = int(np.searchsorted(offsets, at, "right")) - 1
                if at + len(part) <= offsets[d + 1]:
                    out.setdefault(d, set()).update(rules)
                    at = text.find(part, int(offsets[d + 1]))
                else:
                    at = text.find(part, at + 1)
        return out

    def detect(self, text: str, rules: set[int]) -> list[tuple[int, int, Rule]]:
        """Detections of these rules that survive suppression, by place; ``text`` is lower-cased."""
        hits: list[tuple[int, int, int]] = []
        tags = [m.span(1) + (m.start(),) for m in SPDX.finditer(text)] if any(self.rules[i][0].spdx for i in rules) else []
        for i in sorted(rules):
            if self.rules[i][0].spdx:
                hits += [(tag if m.start() == a else m.start(), m.end(), i) for a, e, tag in tags for m in self.rules[i][1].finditer(text, a, e)]
            else:
                hits += [(m.start(), m.end(), i) for m in self.rules[i][1].finditer(text)]
        return [(s, e, self.rules[i][0]) for s, e, i in survivors(hits, lambda i: -self.rules[i][0].priority)]


def survivors(hits: list[tuple[int, int, int]], order) -> list[tuple[int, int, int]]:
    """Hits (start, end, rule) that lie in no hit of better rank.

    Rank: ``order(rule)``, longer first, earlier first, rule.  One sweep by
    start keeps, over a Fenwick tree on the ends, the best rank among intervals
    that reach at least so far.
    """
    ranked = sorted(set(hits), key=lambda h: (order(h[2]), h[0] - h[1], h[0], h[2]))
    ends = sorted({e for _, e, _ in ranked}, reverse=True)
    place = {e: i + 1 for i, e in enumerate(ends)}
    best = [len(ranked)] * (len(ends) + 1)
    sweep = sorted(range(len(ranked)), key=lambda r: (ranked[r][0], -ranked[r][1], r))
    kept = []
    for r in sweep:
        i, least = place[ranked[r][1]], len(ranked)
        while i:
            least = min(least, best[i])
            i &= i - 1
        if least > r:
            kept.append(ranked[r])
        i = place[ranked[r][1]]
        while i < len(best):
            best[i] = min(best[i], r)
            i += i & -i
    return sorted(kept)


def _hash_of(words: str) -> np.ndarray:
    data = np.frombuffer(words.encode(), np.uint8)
    starts, ends, _ = spans(data, np.array([0, len(data)]), ALNUM)
    return word_hashes(data, starts, ends)


@lru_cache(maxsize=4)
def scanner(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner(rules)


def scan_batch(ids: pa.Array, texts: pa.Array, rules: tuple[Rule, ...]) -> pa.Table:
    sc = scanner(rules)
    data, offsets = buffers(texts)
    n = len(ids)
    n_words, n_base = np.zeros(n, np.int64), np.zeros(n, np.int64)
    first, last = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    base_labels: list[set[str]] = [set() for _ in range(n)]
    labels: list[set[str]] = [set() for _ in range(n)]
    score, n_det = np.zeros(n), np.zeros(n, np.int64)
    for at, raw, off in chunks(data, offsets):
        low = LOWER[raw]
        starts, ends, word0 = spans(low, off, ALNUM)
        h = word_hashes(low, starts, ends)
        n_words[at:at + len(off) - 1] = np.diff(word0)
        doc = np.repeat(np.arange(len(off) - 1), np.diff(word0))
        for phrase, label in sc.base:
            k = len(phrase)
            if len(h) < k:
                continue
            here = h[:len(h) - k + 1] == phrase[0]
            for j in range(1, k):
                here &= h[j:len(h) - k + 1 + j] == phrase[j]
            here &= doc[:len(doc) - k + 1] == doc[k - 1:]
            for w in np.flatnonzero(here):
                d, place = at + doc[w], w - word0[doc[w]]
                n_base[d] += 1
                first[d] = place if first[d] < 0 else min(first[d], place)
                last[d] = max(last[d], place)
                base_labels[d].add(label)
                score[d] = max(score[d], BASE_SCORE)
        for d, found in sc.gate(low, off).items():
            text = low[off[d]:off[d + 1]].tobytes().decode()
            kept = sc.detect(text, found)
            n_det[at + d] = len(kept)
            for _, _, r in kept:
                labels[at + d].add(r.label)
                score[at + d] = max(score[at + d], r.score)
    return pa.table({
        "doc_id": ids, "n_words": n_words, "n_base": n_base,
        "first_word": pa.array(first, mask=n_base == 0), "last_word": pa.array(last, mask=n_base == 0),
        "base_labels": [",".join(sorted(b)) for b in base_labels],
        "labels": [",".join(sorted(b | m)) for b, m in zip(base_labels, labels)],
        "score": score, "n_detections": n_det})


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] | None = None) -> DataFrame:
    """License labels of every whole text of ``df``, one row for each of its rows."""
    rules = rule_set() if rules is None else rules
    return map_batches(id_and_text(df, id_col, text_col), lambda b: scan_batch(b.column(0), b.column(1), rules), SCHEMA)


def detections(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] | None = None) -> DataFrame:
    """The surviving detections themselves: doc_id, label, start, end (code points), priority, score."""
    rules = rule_set() if rules is None else rules

    def run(b: pa.RecordBatch) -> pa.Table:
        sc, rows = scanner(rules), []
        data, offsets = buffers(b.column(1))
        low = LOWER[data]
        gate = sc.gate(low, offsets)
        for d, i in enumerate(b.column(0).to_pylist()):
            found = gate.get(d)
            if found:
                text = low[offsets[d]:offsets[d + 1]].tobytes().decode()
                rows += [(i, r.label, s, e, r.priority, r.score) for s, e, r in sc.detect(text, found)]
        return pa.table(dict(zip(("doc_id", "label", "start", "end", "priority", "score"),
                                 [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 6, (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.float64()))])))
    return map_batches(id_and_text(df, id_col, text_col), run, "doc_id long, label string, start long, end long, priority long, score double")

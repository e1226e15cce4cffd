"""Language identification by Bayesian fusion of evidence.

    log P(l | all) = log P(l | host) + log P(declared | l) + log P(path | l) + w * log P(text | l)

*   Text: multinomial over hashed byte trigrams of the lower-cased letters, one
    distribution for each language, counted over all labelled texts.  One more
    class, ``und``, spreads its mass evenly: what no language explains better
    than noise is undetermined.
*   Declared markup language and a language-like path segment: smoothed tables of
    how often each value meets each language, by grouped counts.
*   Host prior: counts of the text verdicts for the host, smoothed towards its
    domain, that towards its address suffix, that towards all rows.  A row's own
    verdict is taken out of every level before it is judged.

Languages are those with at least ``LEAST_TRIGRAMS`` in the labelled texts, whatever
the size of the table; their models, ``BUCKETS`` counts each, reach the driver.
Declared values and paths count as a language, ``other`` or ``none``.
Hosts have no bound: their counts stay a table and are joined (a frequent host's
rows are then the planner's to split).

Defined results: null or empty text, or text without letters, is ``und`` with no
text evidence; a null address has the empty host; a null declaration is ``none``;
rows are judged one by one, repeated rows alike; with nothing labelled every row
is ``und``; an empty table gives an empty table.  ``identify`` leaves other
columns out; ``keep`` passes all columns on.
"""

from __future__ import annotations

import html as markup
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import col, map_batches, plain_names, short_batches, with_schema_of
from tidewater.llm.text import buffers, chunks
from tidewater.session import materialize

BUCKETS = 1 << 14
LEAST_TRIGRAMS = 1000    # labelled, for a language to have a model
SMOOTH = 0.5             # added to each trigram bucket
TEXT_WEIGHT, TEXT_ROOM = 0.3, 300.0    # trigrams overlap; a long text counts as this many of them
KAPPA = (10.0, 20.0, 50.0, 1.0)        # pull of domain on host, suffix on domain, all on suffix, even on all
UND, UND_PRIOR = "und", 0.01
MIN_CONFIDENCE = 0.4     # a text that mixes two known languages is still kept

_LETTER = np.full(256, 0x20, np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[65:91] = np.arange(97, 123)
_LETTER[0x80:] = np.arange(0x80, 256)
_ADDRESS = re.compile(r"^(?:[a-z][a-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)[^/?#]*([^?#]*)", re.I)
# No tag reaches beyond the next "<": every pattern then reads a page once, whatever stands in it.
_HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)|<[^<>]*>", re.I | re.S)
_TAG = re.compile(r"<(html|meta)\b([^<>]*)", re.I)
_LANG = re.compile(r"\blang\s*=\s*[\"']?([a-z]{2,3})\b", re.I)
_CONTENT = re.compile(r"content-language.*?content\s*=\s*[\"']?([a-z]{2,3})\b", re.I | re.S)
# numeric references beyond the last character, and zeros before others: their digits are no number to be read
_HUGE = re.compile(r"&#(?:0*[1-9][0-9]{7,}|x0*[1-9a-f][0-9a-f]{6,});?", re.I)
_ZEROS = re.compile(r"(&#x?)0{4,}(?=[0-9a-f])", re.I)
_SEGMENT = re.compile(r"/([a-z]{2})(?:[\-_][a-z]{2})?(?=/|$)", re.I)


def page_text(html: str) -> tuple[str, str | None]:
    """Visible text and declared language of a page: of the first ``html`` tag that names one, else of the first
    ``meta`` tag that does.  Time grows with the page's length alone."""
    found = None
    for tag in _TAG.finditer(html):
        is_html = tag[1].lower() == "html"
        if is_html or found is None:
            m = _LANG.search(tag[2]) if is_html else _declared_content(tag[2])
            found = m[1].lower() if m else found
            if m and is_html:
                break
    plain = _ZEROS.sub(r"\1", _HUGE.sub("\ufffd", _HIDDEN.sub(" ", html)))
    return markup.unescape(plain), found


def _declared_content(attributes: str) -> re.Match | None:
    """The content attribute behind the first mention of the header."""
    at = attributes.lower().find("content-language")
    return _CONTENT.match(attributes, at) if at >= 0 else None


def split_address(url: str | None) -> tuple[str, str, str, str | None]:
    """Host, its last two labels, its last label and a language-like path segment.  What is no
    address at all is taken as a host name."""
    m = _ADDRESS.match(url or "")
    host, path = (m[1].lower().rstrip("."), m[2]) if m else ((url or "").lower(), "")
    labels = host.split(".")
    segment = _SEGMENT.search(path)
    return host, ".".join(labels[-2:]), labels[-1], segment[1].lower() if segment else None


def trigram_buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every trigram inside a document that holds a letter, and its document."""
    x = _LETTER[data].astype(np.uint32)
    if len(x) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = x[:-2] | x[1:-1] << np.uint32(8) | x[2:] << np.uint32(16)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    ok = (doc[:-2] == doc[2:]) & (code != 0x202020)
    bucket = (code[ok] * np.uint32(0x9E3779B1)) >> np.uint32(32 - 14)
    return bucket.astype(np.int64), doc[:-2][ok]


@dataclass
class TextModel:
    languages: list[str]             # und is the last
    log_p: np.ndarray                # bucket x language

    def evidence(self, texts: pa.Array) -> np.ndarray:
        """Weighted log likelihoods, one row for each text (0 without trigrams)."""
        data, offsets = buffers(texts)
        out = np.zeros((len(texts), len(self.languages)))
        for at, d, o in chunks(data, offsets):
            bucket, doc = trigram_buckets(d, o)
            n = len(o) - 1
            count = np.bincount(doc, minlength=n)
            weight = TEXT_WEIGHT * np.minimum(1.0, TEXT_ROOM / np.maximum(count, 1))
            for j in range(len(self.languages)):
                out[at:at + n, j] = np.bincount(doc, self.log_p[bucket, j], n) * weight
        return out


def train(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text") -> TextModel:
    """Trigram distributions of the languages in ``labelled``, counted over all of its texts."""
    rows = labelled.select(F.lower(col(lang_col).cast("string")).alias("lang"), F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text")).where("lang IS NOT NULL AND lang != ''")

    def run(b: pa.RecordBatch) -> pa.Table:
        data, offsets = buffers(b.column(1))
        lang = b.column(0).dictionary_encode()
        code = lang.indices.to_numpy()
        counts = np.zeros((len(lang.dictionary), BUCKETS), np.int64)
        for at, d, o in chunks(data, offsets):
            bucket, doc = trigram_buckets(d, o)
            counts += np.bincount(code[at + doc] * BUCKETS + bucket, minlength=counts.size).reshape(counts.shape)
        who, bucket = np.nonzero(counts)
        return pa.table({"lang": lang.dictionary.take(pa.array(who)), "bucket": bucket, "n": counts[who, bucket]})
    found = materialize(map_batches(rows, run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "trigrams")
    known = found.groupBy("lang").agg(F.sum("n").alias("all")).where(F.col("all") >= LEAST_TRIGRAMS).select("lang")
    languages = sorted(r["lang"] for r in known.collect())
    table = found.join(known, "lang", "left_semi").toArrow()
    counts = np.full((BUCKETS, len(languages) + 1), SMOOTH)
    counts[:, -1] = 1.0
    place = {x: i for i, x in enumerate(languages)}
    np.add.at(counts, (table.column("bucket").to_numpy(), np.array([place[x] for x in table.column("lang").to_pylist()], np.int64)), table.column("n").to_numpy())
    return TextModel([*languages, UND], np.log(counts / counts.sum(axis=0)))


# ---------------------------------------------------------------- evidence of rows
Reader = Callable[[pa.RecordBatch], tuple[pa.Array, list, list]]     # texts, declared languages, parts of addresses


def read_pages(b: pa.RecordBatch) -> tuple[pa.Array, list, list]:
    """Reader for (id, html, url) rows."""
    pairs = [page_text(h or "") for h in b.column(1).to_pylist()]
    return pa.array([t for t, _ in pairs], pa.string()), [d for _, d in pairs], [split_address(a) for a in b.column(2).to_pylist()]


def read_plain(b: pa.RecordBatch) -> tuple[pa.Array, list, list]:
    """Reader for (id, text, declared, host) rows; the host is taken as it is."""
    labels = [(h or "", (h or "").split(".")) for h in b.column(3).to_pylist()]
    return b.column(1), b.column(2).to_pylist(), [(h, ".".join(x[-2:]), x[-1], None) for h, x in labels]


def _codes(values: list, languages: list[str]) -> np.ndarray:
    """Index of the language; then other, none."""
    place = {x: i for i, x in enumerate(languages[:-1])}
    n = len(languages) - 1
    return np.array([n + 1 if not v else place.get(str(v).lower(), n) for v in values], np.int64)


def evidence_table(rows: DataFrame, read: Reader, model: TextModel) -> DataFrame:
    """id, text evidence, text verdict, codes of the declared language and the path, host, domain, suffix."""
    rows = plain_names(rows)
    def run(b: pa.RecordBatch) -> pa.Table:
        texts, declared, parts = read(b)
        e = model.evidence(texts)
        verdict = np.where(e.any(axis=1), np.argmax(e, axis=1), len(model.languages) - 1)
        return pa.table({"id": b.column(0), "evidence": pa.FixedSizeListArray.from_arrays(e.reshape(-1), e.shape[1]).cast(pa.list_(pa.float64())),
                         "verdict": verdict, "declared": _codes(declared, model.languages), "path": _codes([p[3] for p in parts], model.languages),
                         "host": [p[0] for p in parts], "domain": [p[1] for p in parts], "suffix": [p[2] for p in parts]})
    return materialize(map_batches(rows, run, "id long, evidence array<double>, verdict long, declared long, path long, host string, domain string, suffix string"), "language-evidence")


@dataclass
class Tables:
    """Smoothed log tables: value x language; and the verdicts of all rows."""
    declared: np.ndarray
    path: np.ndarray
    all: np.ndarray


def _counts_by(table: DataFrame, key: list[str], n: int, name: str) -> DataFrame:
    each = F.array(*[F.sum(F.when(F.col("verdict") == i, F.col("n")).otherwise(0)) for i in range(n)])
    return table.groupBy(*key).agg(each.alias(name))


def fuse_tables(evidence: DataFrame, model: TextModel) -> tuple[Tables, DataFrame]:
    """The bounded tables, and for each host the verdict counts of host, domain and suffix."""
    n = len(model.languages)
    by_value = evidence.groupBy("declared", "path", "verdict").agg(F.count(F.lit(1)).alias("n")).collect()      # (n+1)^2 n rows at most
    declared, path, total = np.full((n + 1, n), 0.5), np.full((n + 1, n), 0.5), np.zeros(n)
    for r in by_value:
        declared[r["declared"], r["verdict"]] += r["n"]
        path[r["path"], r["verdict"]] += r["n"]
        total[r["verdict"]] += r["n"]
    pairs = materialize(evidence.groupBy("host", "domain", "suffix", "verdict").agg(F.count(F.lit(1)).alias("n")), "host-verdicts")
    hosts = _counts_by(pairs, ["host", "domain", "suffix"], n, "by_host")
    hosts = hosts.join(_counts_by(pairs, ["domain"], n, "by_domain"), "domain").join(_counts_by(pairs, ["suffix"], n, "by_suffix"), "suffix")
    return Tables(np.log(declared / declared.sum(axis=0)), np.log(path / path.sum(axis=0)), total), \
        materialize(hosts.select("host", F.concat("by_host", "by_domain", "by_suffix").alias("counts")), "hosts")


def posterior(evidence: np.ndarray, verdict: np.ndarray, declared: np.ndarray, path: np.ndarray, counts: np.ndarray, tables: Tables) -> np.ndarray:
    """Probabilities of the languages, one row for each row of evidence."""
    n = evidence.shape[1]
    own = np.zeros_like(evidence)
    own[np.arange(len(own)), verdict] = 1.0
    prior = np.full(n, (1 - UND_PRIOR) / max(n - 1, 1))
    prior[-1] = UND_PRIOR if n > 1 else 1.0
    levels = [np.broadcast_to(tables.all, own.shape), counts[:, 2 * n:], counts[:, n:2 * n], counts[:, :n]]
    p = np.broadcast_to(prior, own.shape)
    for level, kappa in zip(levels, reversed(KAPPA)):
        left = np.maximum(level - own, 0.0)
        p = (left + kappa * p) / (left.sum(axis=1, keepdims=True) + kappa)
    log = np.log(np.maximum(p, 1e-12)) + tables.declared[declared] + tables.path[path] + evidence
    log -= log.max(axis=1, keepdims=True)
    out = np.exp(log)
    out /= out.sum(axis=1, keepdims=True)
    nothing = ~evidence.any(axis=1)         # no letters: whatever is declared, there is no text in a language
    out[nothing] = 0.0
    out[nothing, -1] = 1.0
    return out


def _lists(a: pa.Array, width: int) -> np.ndarray:
    return a.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _verdicts(p: np.ndarray, languages: list[str], least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    best = np.argmax(p, axis=1)
    sure = p[np.arange(len(p)), best]
    return np.array(languages, object)[best], sure, (best < len(languages) - 1) & (sure >= least)


def identify(rows: DataFrame, read: Reader, model: TextModel, least: float = MIN_CONFIDENCE) -> DataFrame:
    """id, lang, confidence, text_lang, declared, kept for every row (an id column first, then what ``read`` takes)."""
    found = evidence_table(rows, read, model)
    tables, hosts = fuse_tables(found, model)
    n = len(model.languages)

    def run(b: pa.RecordBatch) -> pa.Table:
        p = posterior(_lists(b.column(1), n), *(b.column(i).to_numpy() for i in (2, 3, 4)), _lists(b.column(5), 3 * n).astype(float), tables)
        lang, sure, kept = _verdicts(p, model.languages, least)
        names = [*model.languages[:-1], "other", "none"]
        return pa.table({"id": b.column(0), "lang": pa.array(lang, pa.string()), "confidence": sure,
                         "text_lang": [model.languages[i] for i in b.column(2).to_pylist()],
                         "declared": [names[i] for i in b.column(3).to_pylist()], "host": b.column(6), "kept": kept})
    joined = found.join(hosts, "host").select("id", "evidence", "verdict", "declared", "path", "counts", "host")
    return map_batches(joined, run, "id long, lang string, confidence double, text_lang string, declared string, host string, kept boolean")


def keep(df: DataFrame, model: TextModel, text_col: str = "text", declared_col: str = "lang", host_col: str = "source",
         least: float = MIN_CONFIDENCE) -> DataFrame:
    """The rows of ``df`` in a known language, with all their columns."""
    host = F.coalesce(F.lower(col(host_col).cast("string")), F.lit(""))
    plain = df.select(F.lit(0).cast("long"), col(text_col).cast("string"), col(declared_col).cast("string"), host)
    tables, hosts = fuse_tables(evidence_table(plain, read_plain, model), model)
    n, rows = len(model.languages), plain_names(df)
    width, names = len(rows.columns), df.columns
    at = [names.index(c) for c in (text_col, declared_col, host_col)]
    own = F.coalesce(F.lower(F.col(f"c{at[2]}").cast("string")), F.lit(""))
    joined = rows.join(hosts, own == F.col("host"), "left").select(*rows.columns, "counts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            e = model.evidence(b.column(at[0]))
            verdict = np.where(e.any(axis=1), np.argmax(e, axis=1), n - 1)
            none = pa.scalar([0] * (3 * n), b.column(width).type)
            counts = _lists(b.column(width).fill_null(none), 3 * n).astype(float)
            codes = _codes(b.column(at[1]).to_pylist(), model.languages)
            p = posterior(e, verdict, codes, np.full(len(e), n, np.int64), counts, tables)
            yield b.select(list(range(width))).filter(pa.array(_verdicts(p, model.languages, least)[2]))
    short_batches(df.sparkSession)
    return with_schema_of(joined.mapInArrow(run, rows.schema), df)

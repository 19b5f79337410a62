"""Secret scan: fixed patterns, plus strings that stay incompressible in a sensitive context.

The base kinds (assign, access, hex) are leftmost non-overlapping pattern matches. The method adds
kind ``novel``: every long token near a sensitive word, on either side, is compressed together with the text around it
by zstandard primed with a dictionary of identifiers and code; where its marginal compressed bytes
reach ``NOVEL`` of its length, neither the surroundings nor the dictionary explain it, and it is
reported. Base spans are never dropped; a novel span that overlaps one is not added.

Everything is one pass over whole texts without a shuffle. Offsets count code points.

Defined results: null or empty text has no spans; repeated rows repeat; an empty table gives an
empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from hashlib import sha256

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from .plan import bounded_batches

KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # the maximal runs of [0-9a-f]+ that have the length
SENSITIVE = re.compile(r"(?i:passw|secret|token|credential|api.?key|private.?key|access.?key|bearer|auth|signature|cookie)", re.A)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
#: Words one of which a text must hold (lower-cased) for the searches above to find anything.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api")
SENSITIVE_WORDS = ("passw", "secret", "token", "credential", "key", "bearer", "auth", "signature", "cookie")
#: Code points after or before a sensitive word in which a candidate may start, code points of surroundings
#: on either side, and the least marginal bytes a code point.
REACH, AROUND, NOVEL = 48, 256, 0.88
#: Bytes of the dictionary that stand ahead of both texts, so that neither is too short to be compressed at all.
PRIMER = 400
#: Identifiers and code that real source holds, and common words; candidates made of these compress away.
DICTIONARY = """
user account id name key value list map set get index count size type file path data item node table column row query result status message event state client server host port url address header body
content option parameter argument module package version number group order price product customer payment invoice image page view model form field input output start stop create add remove find search filter sort merge
split parse format load save send receive connect process task job queue worker thread cache buffer stream batch time date zone user_id file_name base_url max_size min_value is_valid has_next to_json from_dict
public static final void private protected class struct interface import from return function const var let def self this
String string int integer long float double boolean bool true false null None undefined new delete try except catch finally throw raise
if else elif for while switch case break continue default lambda async await yield with open read write close flush
http https www com org net api v1 v2 json xml html utf-8 application content-type authorization bearer basic accept user-agent
username password passwd secret token api_key apikey access_key secret_key private_key client_id client_secret refresh_token
session cookie signature credential credentials config configuration settings environment production development localhost
getElementById addEventListener innerHTML createElement className toString hashCode equals length append insert update select
AbstractFactory Builder Controller Manager Service Repository Handler Listener Provider Adapter Context Exception Error Request Response
example placeholder changeme your_api_key_here your_token_here xxxxxxxxxxxxxxxx 0000000000000000 1234567890 abcdefghijklmnopqrstuvwxyz
ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 -----BEGIN PRIVATE KEY----- -----END PRIVATE KEY----- ssh-rsa node_modules package-lock sha256 md5
the of and to in that is was for with on as by at from this which not are be have has had but or an they their there
"""


def in_cases(dictionary: str) -> str:
    """The dictionary, with its lower-case words also capitalised and in capitals."""
    plain = [w for w in dictionary.replace("_", " ").split() if w.isalpha() and w.islower()]
    return f"{dictionary} {' '.join(w.title() for w in plain)} {' '.join(w.upper() for w in plain)}"


class Novelty:
    """Marginal compressed bytes of a string within its surroundings."""

    def __init__(self, dictionary: str = DICTIONARY):
        raw = in_cases(dictionary).encode()
        words = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(raw) >= 8 else None
        self.primer = raw[:PRIMER]
        self.pack = zstandard.ZstdCompressor(level=19, dict_data=words, write_content_size=False, write_checksum=False, write_dict_id=False).compress

    def marginal(self, before: str, candidate: str, after: str) -> int:
        around = self.primer + before.encode("utf-8", "surrogatepass") + after.encode("utf-8", "surrogatepass") + b" "
        return len(self.pack(around + candidate.encode())) - len(self.pack(around))


def base_spans(text: str, low: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base kinds."""
    out = []
    if (":" in text or "=" in text) and any(w in low for w in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return out


def novel_spans(text: str, low: str, taken: list[tuple[int, int, int]], novelty: Novelty, least: float = NOVEL, reach: int = REACH, around: int = AROUND) -> list[tuple[int, int, int]]:
    """The candidates that overlap no span of ``taken`` and are novel; linear in the text but for what is packed."""
    if not any(w in low for w in SENSITIVE_WORDS):
        return []
    words = [m.span() for m in SENSITIVE.finditer(text)]
    if not words:
        return []
    starts, ends = zip(*words, strict=True)
    lefts, rights, far = [], [], 0  # taken spans by start, with the furthest end so far
    for a, _, b in sorted(taken):
        far = max(far, b)
        lefts.append(a)
        rights.append(far)
    found = []
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        k = bisect_left(ends, start - reach)  # the first word that ends late enough
        if k == len(ends) or starts[k] >= max(end, start + reach + 1):
            continue
        if (i := bisect_left(lefts, end)) and rights[i - 1] > start:
            continue
        if novelty.marginal(text[max(0, start - around) : start], text[start:end], text[end : end + around]) >= least * (end - start):
            found.append((start, 3, end))
    return found


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def scan(docs: DataFrame, key: str = "doc_id", text_col: str = "text", least: float = NOVEL, reach: int = REACH, around: int = AROUND, dictionary: str = DICTIONARY) -> DataFrame:
    """key, n_assign, n_access, n_hex, base_sha256, spans, n_novel for every row."""

    def run(batches):
        novelty = Novelty(dictionary)
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                text = text or ""
                low = text.lower()
                base = base_spans(text, low)
                more = novel_spans(text, low, base, novelty, least, reach, around)
                counts = [sum(k == i for _, k, _ in base) for i in range(3)]
                rows.append((*counts, sha256(listed(base).encode()).hexdigest(), listed(base + more), len(more)))
            columns = zip(*rows, strict=True) if rows else [[]] * 6
            arrays = [pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["key", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_novel"])

    bounded_batches(docs.sparkSession)
    kind = docs.select(key).schema[0].dataType.simpleString()
    return docs.select(key, text_col).mapInArrow(run, f"key {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_novel long")

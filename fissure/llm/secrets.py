"""Secret scans: base patterns plus a character network over every candidate with its context.

Candidates are the base findings, all runs of 16 or more characters of ``[A-Za-z0-9+/_=.-]`` that neither begin nor end with a dot, wherever they stand, and what follows a word such as key, auth or
pwd, if it has 12 or more characters of any kind but white space, quotes and angle brackets. Runs that lie in base findings as a whole are not asked about again. The network reads characters one by one; it scores
every candidate over its whole length, by overlapping windows with the text around them, of which the highest score counts. It is trained on labelled findings: generated from formats
of public services, alone and behind long prefixes, and from lines that hold no secret, with a held-out part for calibration. The threshold is the highest that keeps ``recall`` of the held-out secrets. Base
findings stay whatever their score; other candidates count from the threshold on, each as a whole.

Null texts count as empty. Offsets are code points. Repeated rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from fissure.llm._common import map_text, pick
from fissure.llm.charcnn import CLASSES, TABLE, CharCnn, calibrate, probability

#: Fixed patterns of the base findings, in the order of their kinds.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
MIN_ASSIGN, MIN_ACCESS = 12, 18
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-][A-Za-z0-9+/_=.-]{14,}[A-Za-z0-9+/_=-]")
LEADS = ("key", "auth", "bearer", "pwd", "passphrase", "credential", "pin", "login")
_LEADS = "|".join(LEADS)
#: A lead word where a run of letters begins.
LEAD = re.compile(rf"(?<![a-z])(?:{_LEADS})", re.I | re.A)
#: Words with a mark behind each, between one lead word and the next.
LINKED = re.compile(r"(?:[a-z]+[_-])++", re.I | re.A)
#: From a lead word to the value; no part of it can be read in two ways.
LED = re.compile(rf"""(?:{_LEADS})[a-z_-]{{0,16}}+["']?+(?:\x20*+[:=]\x20*+["']?+([^\s"'<>]{{12,}}+)|\x20++["']?+([^\s"'<>]{{12,}}+))""", re.I | re.A)
BEFORE, INSIDE, AFTER = 24, 32, 4
#: Characters from one window of a candidate to the next.
STEP = 8
WORDS = (b"passw", b"secret", b"token", b"api")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) of the base findings, sorted."""
    out = []
    low = text.encode("utf-8", "surrogatepass").lower()
    if any(w in low for w in WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _begins(text: str, at: int) -> bool:
    """Does a word begin at a lead word, or at one of the words that are linked before it?"""
    while at and text[at - 1] == "_":
        word = at - 1
        while word and text[word - 1].isascii() and text[word - 1].isalpha():
            word -= 1
        if word == at - 1:
            return False
        at = word
    return not at or not (text[at - 1].isascii() and text[at - 1].isalnum())


def led(text: str) -> list[tuple[int, int]]:
    """(start, end) of the values behind lead words, from left to right, none within another.

    Lead words that are linked by letters with single ``_`` or ``-`` in between belong together; the last of them that a value follows counts, if a word begins with them or with a word linked before. Each character is looked at a bounded number of times.
    """
    out, chain, at, end = [], [], 0, 0

    def close() -> None:
        nonlocal at
        for lead in reversed(chain):
            if (m := LED.match(text, lead)) and _begins_before(lead):
                out.append(m.span(m.lastindex))
                at = m.end()
                break

    def _begins_before(lead: int) -> bool:
        # a hyphen before any of them begins a word; else the words before the first one decide
        return "-" in text[chain[0] - 1 : lead] or _begins(text, chain[0]) if chain[0] else True

    for m in LEAD.finditer(text):
        if chain and not LINKED.fullmatch(text, end, m.start()):
            close()
            chain = []
        if m.start() < at:
            continue
        chain.append(end := m.start())
    if chain:
        close()
    return out


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """(start, end) of what the network is asked about beside the base findings, which are sorted; runs that these hold as a whole are left out."""
    runs = {m.span() for m in CANDIDATE.finditer(text)}
    low = text.lower()
    if any(w in low for w in LEADS):
        runs |= set(led(text))
    out, whole = [], []
    for a, _, b in base:
        if whole and a <= whole[-1][1]:
            whole[-1][1] = max(whole[-1][1], b)
        else:
            whole.append([a, b])
    at = 0
    for a, b in sorted(runs):
        while at < len(whole) and whole[at][1] < b:
            at += 1
        if at == len(whole) or not (whole[at][0] <= a and b <= whole[at][1]):
            out.append((a, b))
    return out


def encode(text: str, start: int, end: int) -> np.ndarray:
    """Classes of the characters before, in and after a candidate; those inside are numbered apart."""

    def codes(part: str) -> np.ndarray:
        return TABLE[np.minimum(np.frombuffer(part.encode("utf-32-le", "surrogatepass"), "<u4"), 128)]

    row = np.zeros(BEFORE + INSIDE + AFTER, np.int64)
    head = codes(text[max(0, start - BEFORE) : start])
    row[BEFORE - len(head) : BEFORE] = head
    body = codes(text[start : min(end, start + INSIDE)])
    row[BEFORE : BEFORE + len(body)] = body + CLASSES
    tail = codes(text[end : end + AFTER])
    row[BEFORE + INSIDE : BEFORE + INSIDE + len(tail)] = tail
    return row


def windows(start: int, end: int) -> list[tuple[int, int]]:
    """Overlapping parts of INSIDE characters that cover a candidate; a shorter candidate is its own window."""
    last = max(start, end - INSIDE)
    return [(at, min(end, at + INSIDE)) for at in [*range(start, last, STEP), last]]


SYLLABLES = "th er on an re le de en que ion ge sch ado ing heit keit ung lich ver ein und tion ment able ness ous ant ist mar ter ro la ci ca te da do ra os el wh ed ore in tz ber ch eau ou is ar ie por con".split()
#: Ordinary words of four languages and of programs, for strings that hold no secret.
WORDS_ = """the quick brown fox jumps over lazy dog get set user name from request header value index count number list file path data table row column key type class
object string width height color image button event handler service config manager factory builder server client response error message session account order item price
product customer address street company example article world house water people school church country number night light write things about through because between
against during without before after under while where there which their would could should first second great little small young always never every other many some
und der die das nicht haus wasser leben arbeit zeit schule freund straße gesundheit versicherung gesellschaft wirtschaft entwicklung rechts schutz verordnung grund recht
les des une pour dans avec maison travail enfant gouvernement toujours monde ville temps homme femme jour los las una para con casa trabajo gobierno ciudad siempre mundo
mujer tiempo agua noche""".split()
LOWER_, UPPER_, DIGITS, HEXES = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "0123456789abcdef"
FULL = LOWER_ + UPPER_ + DIGITS


class Draws:
    """Words, prose and strings by format rules."""

    def __init__(self, seed: int):
        self.r = np.random.default_rng(seed)

    def of(self, letters: str, low: int, high: int | None = None) -> str:
        return "".join(letters[i] for i in self.r.integers(0, len(letters), low if high is None else self.r.integers(low, high)))

    def one(self, *choices: str) -> str:
        return choices[self.r.integers(len(choices))]

    def word(self, low: int = 1, high: int = 5) -> str:
        """An ordinary word, or one of ``low`` to ``high`` syllables; some syllables are a vowel between any two letters."""
        if high <= 5 and self.r.random() < 0.5:
            return WORDS_[self.r.integers(len(WORDS_))].replace("ß", "ss")
        loose = self.r.random() < 0.2
        return "".join(self.of(LOWER_, 1) + self.of("aeiou", 1) + self.of(LOWER_, 0, 2) if loose and self.r.random() < 0.5 else SYLLABLES[i] for i in self.r.integers(0, len(SYLLABLES), self.r.integers(low, high)))

    def cased(self) -> str:
        w = self.word()
        return w if self.r.random() < 0.5 else w.capitalize() if self.r.random() < 0.5 else w.upper()

    def prose(self, high: int) -> str:
        return " ".join(self.word() + self.mark() for _ in range(self.r.integers(0, high)))

    def mark(self) -> str:
        return self.one("", "", "", "", "", "", ",", ".", ". ", ":", "é", "ü", "ß", "!", "?", self.of("#$%&*|<>~^@", 1) * self.r.integers(1, 4))

    def uuid(self) -> str:
        return "-".join(self.of(HEXES, n) for n in (8, 4, 4, 4, 12))

    def secret(self) -> tuple[str, str]:
        """What leads to a secret, and the secret."""
        kind = self.r.integers(0, 11)
        lead = self.one("key = ", "auth: ", "Authorization: Bearer ", "api-token=", 'client_key: "', "credential ", "pwd=", "export ACCESS=", "", "")
        strong = self.one("key = ", "auth: ", "Bearer ", "credential=", 'pwd: "', "private_key=", "login: ", "KEY=")
        mark = self.one("_", "-")
        if kind == 0:
            return strong, self.of(FULL, 16, 45)
        if kind == 1:
            return lead, mark.join([self.of(LOWER_, 2, 6), *(self.one("live", "test", "proj", "pat", "v1") for _ in range(self.r.integers(0, 2))), self.of(FULL + self.one("", "_-"), 16, 49)])
        if kind == 2:
            return lead, self.of(FULL + "+/", 24, 61) + "=" * self.r.integers(0, 3)
        if kind == 3:
            return lead, self.of(UPPER_ + DIGITS, 18, 33)
        if kind == 4:
            return strong, self.of(HEXES, int(self.one("32", "40", "64")))
        if kind == 5:
            return lead, self.of(LOWER_ + UPPER_, 20, 45)
        if kind == 6:
            return lead, "eyJ" + self.of(FULL, 15, 40) + ".eyJ" + self.of(FULL, 30, 90) + "." + self.of(FULL + "_-", 43)
        if kind == 7:
            return lead, "-".join([self.of(LOWER_, 4), self.of(DIGITS, 10, 14), self.of(DIGITS, 10, 14), self.of(FULL, 24)])
        if kind == 8:
            return strong, self.of(FULL + "!#$%&*+?@^~", 12, 24)
        if kind == 9:
            return lead, self.of(FULL, 2, 8) + self.of(FULL + "_-", 22, 45)
        return self.one("client_key ", "auth: ", "credential: ", "key="), self.uuid()

    def harmless(self) -> tuple[str, str]:
        """What leads to a string that is no secret, and the string."""
        kind, words = self.r.integers(0, 19), [self.word() for _ in range(self.r.integers(3, 7))]
        lead = self.one("", "", "", "see ", "page ", "id ", "call ", "version ", "https://", "key: ", "the key ", "pin ", "login = ", "author ")
        some = [
            lambda: self.of(DIGITS, 16, 21), lambda: "-".join(words) + "-" + self.of(DIGITS, 2), lambda: "_".join(words[:3]) + "_v" + self.of(DIGITS, 1), lambda: f"2{self.of(DIGITS, 3)}-{self.of(DIGITS, 2)}-{self.of(DIGITS, 2)}-{self.of(DIGITS, 8)}",
            lambda: "/".join([*words, self.word() + self.of(DIGITS, 2)]), lambda: "-" * 12 + self.of(DIGITS, 1) + "-" * 12, lambda: "".join(words) + self.of(DIGITS, 1), lambda: words[0] + "".join(w.capitalize() for w in words[1:]),
            lambda: self.one("_", "-").join(words).upper(), lambda: "/".join(words), lambda: self.one("_", "-", "/").join(w.capitalize() for w in words), lambda: "".join(words), lambda: self.one("-", "=", "_", "/", "-=", "A", "x", "+", "-.") * self.r.integers(16, 80),
            lambda: self.word(8, 14), lambda: self.word(8, 14).capitalize(), lambda: f"www.{self.word()}{self.word()}.{self.one('com', 'org', 'de', 'fr')}/" + "/".join(words), lambda: ".".join(words) + self.one(".py", ".html", ".txt", ".Der"), lambda: f"{words[0]}.{self.word().capitalize()}{self.word()}.{self.word()}",
            lambda: f"2{self.of(DIGITS, 3)}-{self.of(DIGITS, 2)}-{self.of(DIGITS, 2)}T{self.of(DIGITS, 2)}:00:{self.of(DIGITS, 2)}.{self.of(DIGITS, 3)}Z",
        ]
        if self.r.random() < 0.06:
            return self.one("row ", "id ", "", "was "), self.uuid()
        body = some[kind]()
        return lead, body + self.word(2, 5) * (len(body) < 16) + "er" * 8 * (len(body) < 12)


def findings(n: int = 6000, seed: int = 11) -> list[tuple[str, int, int, int]]:
    """Labelled findings (text, start, end, secret 0 or 1), half of each class, drawn from format rules."""
    d, out = Draws(seed), []
    for i in range(n):
        before, after = d.prose(6), d.prose(4)
        lead, body = d.secret() if i % 2 else d.harmless()
        text = f"{before} {lead}{body}{d.mark()} {after}"
        at = len(before) + 1 + len(lead)
        out.append((text, at, at + len(body), i % 2))
    return out


def hidden(n: int = 2000, seed: int = 12) -> list[tuple[str, int, int, int]]:
    """Labelled findings like ``findings`` in runs that begin with a path, a part of an address, or a name; those without a secret are as long."""
    d, out = Draws(seed), []
    for text, start, end, secret in findings(n, seed + 1000):
        mark = d.one("/", "/", "_", "-")
        words = [d.cased() for _ in range(d.r.integers(3, 16))]
        if d.r.random() < 0.3:
            words[d.r.integers(len(words))] += str(d.r.integers(1, 2100))
        prefix = mark * (d.r.random() < 0.7) + mark.join(words) + d.one("/", "=", "_", "-")
        suffix = "/" + d.word() if d.r.random() < 0.2 else ""
        at = start + len(prefix)
        out.append((text[:start] + prefix + text[start:end] + suffix + text[end:], at, at + end - start, secret))
    return out


def run_of(text: str, start: int, end: int) -> tuple[int, int] | None:
    """The candidate run that holds a finding; None where the filter lets none through."""
    return next((run for run in candidates(text, []) if run[0] <= start and end <= run[1]), None)


def best_scores(net: CharCnn, spans: list[tuple[str, int, int]], sent: int = 4096) -> np.ndarray:
    """The highest logit of any window of each (text, start, end)."""
    best = np.full(len(spans), -np.inf)
    parts = [(i, a, b) for i, (_, s, e) in enumerate(spans) for a, b in windows(s, e)]
    for at in range(0, len(parts), sent):
        part = parts[at : at + sent]
        np.maximum.at(best, [i for i, *_ in part], net.logits(np.stack([encode(spans[i][0], a, b) for i, a, b in part])))
    return best


def labelled(data: list[tuple[str, int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Windows to learn from. Of a run with a secret, those that lie in it or hold most of it are secrets, those that touch none of it are not, the rest is left out."""
    x, y = [], []
    for text, start, end, secret in data:
        x.append(encode(text, start, end))
        y.append(secret)
        for a, b in windows(*(run_of(text, start, end) or (start, end))):
            shared = min(b, end) - max(a, start)
            if not secret or shared <= 0 or shared >= min(end - start, INSIDE) * 0.75:
                x.append(encode(text, a, b))
                y.append(secret and shared > 0)
    return np.stack(x), np.array(y, float)


@lru_cache(2)
def model(recall: float) -> tuple[CharCnn, tuple[float, float], float]:
    """Network, calibration and threshold; the same for the same parameter. Held-out secrets that no candidate holds count as missed."""
    data = findings() + hidden()
    held = np.arange(len(data)) // 2 % 4 == 3
    net = CharCnn(BEFORE + INSIDE + AFTER)
    net.train(*labelled([d for d, h in zip(data, held, strict=True) if not h]))
    kept = [(d, run_of(*d[:3])) for d, h in zip(data, held, strict=True) if h]
    y = np.array([d[3] for d, run in kept if run], float)
    z = best_scores(net, [(d[0], *run) for d, run in kept if run])
    a, b = calibrate(z, y)
    p = np.sort(probability(a, b, z[y == 1]))
    missed = sum(d[3] for d, run in kept if not run)
    return net, (a, b), float(p[max(0, int((1 - recall) * (len(p) + missed)) - missed)])


def scan(docs: DataFrame, recall: float = 0.98) -> DataFrame:
    """``(doc_id, base, spans)`` of every row of ``docs(doc_id, text)``; both are arrays of (kind, start, end, score) by start."""
    found = model(recall)
    span = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())]))
    schema = T.StructType([pick(docs, "doc_id").schema["doc_id"], T.StructField("base", span), T.StructField("spans", span)])

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        base, spans = find_all([x or "" for x in batch.column("text").to_pylist()], found)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(base, kind), pa.array(spans, kind)], names=["doc_id", "base", "spans"])

    return map_text(pick(docs, "doc_id", "text"), kernel, schema)


def find_all(texts: list[str], found) -> tuple[list[list[dict]], list[list[dict]]]:
    """Base spans and all spans of each text."""
    net, (a, b), threshold = found
    asked: list[tuple[int, int, int, int]] = []
    for i, text in enumerate(texts):
        base = base_spans(text)
        asked += [(i, s, k, e) for s, k, e in base]
        asked += [(i, s, len(KINDS), e) for s, e in candidates(text, base)]
    names, kept, every = (*KINDS, "network"), [[] for _ in texts], [[] for _ in texts]
    p = probability(a, b, best_scores(net, [(texts[i], s, e) for i, s, _, e in asked]))
    for (i, s, k, e), x in zip(asked, p.tolist(), strict=True):
        span = {"kind": names[k], "start": s, "end": e, "score": x}
        if k < len(KINDS):
            kept[i].append(span)
        if k < len(KINDS) or x >= threshold:
            every[i].append(span)
    order = lambda x: (x["start"], names.index(x["kind"]))
    return [sorted(x, key=order) for x in kept], [sorted(x, key=order) for x in every]


def joined(spans: list[dict]) -> str:
    return ",".join(f"{x['kind']}:{x['start']}:{x['end']}" for x in spans)


def digests(docs: DataFrame, recall: float = 0.98) -> DataFrame:
    """Counts by kind, digest of the base spans and all spans as text, for every row of ``docs(doc_id, text)``."""

    def run(batches):
        for batch in batches:
            base = batch.column("base").to_pylist()
            counts = [pa.array([sum(x["kind"] == k for x in row) for row in base], pa.int64()) for k in KINDS]
            digest = [hashlib.sha256(joined(x).encode()).hexdigest() for x in base]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *counts, pa.array(digest, pa.string()), pa.array([joined(x) for x in batch.column("spans").to_pylist()], pa.string())], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return scan(docs, recall).mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact(docs: DataFrame, recall: float = 0.98, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each secret in ``text`` replaced by ``mark``; overlapping spans are replaced together. ``n_chars``, where there is one, is counted anew."""
    found = model(recall)

    def clean(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        _, spans = find_all([x or "" for x in texts], found)
        out = []
        for text, row in zip(texts, spans, strict=True):
            parts, at = [], 0
            for x in row:
                if x["start"] >= at:
                    parts += [text[at : x["start"]], mark]
                at = max(at, x["end"])
            out.append("".join([*parts, text[at:]]) if row else text)
        for name, values in (("text", out), ("n_chars", [None if x is None else len(x) for x in out])):
            if name in batch.schema.names:
                i = batch.schema.get_field_index(name)
                batch = batch.set_column(i, name, pa.array(values, batch.schema.field(i).type))
        return batch

    return map_text(docs, clean, docs.schema)

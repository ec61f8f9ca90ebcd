"""Personal data: exact base patterns plus spans learnt from labelers that vote.

Candidates beyond the base patterns are looked for in what base spans leave: values of secret keys,
written-out addresses, grouped account and phone numbers, and runs with a digit or an ``@``.
Labelers of three families (patterns, gazetteers, context) vote on each; expectation-maximisation
estimates their reliabilities from the vote counts of all documents, and a logistic span classifier
is trained on the posteriors.  Only counts over bounded vote and feature patterns leave the tasks.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import map_rows, pieces

BASE = ("email", "ip", "card", "phone")
ADDED = ("secret", "number", "contact")
KINDS = BASE + ADDED

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin where a run of digits begins, so the look-behind changes nothing but the time on long runs.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from each ``@`` outwards in linear time."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start."""
    out = [("email", a, b) for a, b in emails(text)]
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() and c.isascii() for c in m[0]) <= 15:
                out.append(("phone", *m.span()))
    return out


# Gazetteers and cue words: fixed values.
SECRET_KEYS = frozenset("password passwd pwd pass passwort contraseña token secret apikey api_key api-key access_key key auth bearer credential credentials pin".split())
CONTACT_CUES = frozenset("phone tel telephone telefon teléfono téléphone call mobile fax handy móvil mail e-mail email correo contact kontakt contacto write".split())
ID_CUES = frozenset("ssn passport iban account konto cuenta compte nif dni id-card tax steuer-id license-no member customer-id card visa mastercard".split())
BENIGN_CUES = frozenset("version v page chapter figure table section step version: year in since seit depuis desde of room line kapitel seite página".split())
MAIL_WORDS = frozenset("gmail yahoo outlook hotmail example mail icloud proton gmx web aol".split())

PASSWORDS = frozenset("password passwd pwd passwort contraseña".split())

_HEX = re.compile(r"[0-9a-fA-F]{16,}")
_MIXED = re.compile(r"(?=[^0-9]*[0-9])(?=[^A-Za-z]*[A-Za-z])[A-Za-z0-9_\-./+]{16,}")
_NUMBER = re.compile(r"\(?[0-9][0-9().\-/]*[0-9]")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}")
_OBFUSCATED = re.compile(r"[A-Za-z0-9._%+-]+ ?(?:\(at\)|\[at\]|\(@\)|\{at\}) ?[A-Za-z0-9.-]+", re.I)
_SMALL = re.compile(r"[0-9]{1,4}(?:[.,:/][0-9]{1,4}){0,2}%?")
_EDGE = "\"'`([{<>)]}.,;:!?#*$%&|"
LABELERS = ("pattern_secret", "pattern_number", "pattern_small", "gazetteer_key", "gazetteer_mail", "context_cue", "context_benign")

_HINT = re.compile(r"[0-9@=:(\[{]")
_ASSIGN = re.compile(r"[=:]")
_NAME = re.compile(r"(?<![\w-])([^\W\d][\w-]{0,31})[\"'`]?[ \t]{0,2}$")
_KEY = re.compile(r"(?<![\w-])([^\W\d][\w-]{0,31})[\"'`]?[ \t]{0,2}[=:][=>]{0,2}[ \t]{0,2}[\"'`(]?$")
_GAP = re.compile(r"[=>]{0,2}[ \t]{0,2}")
_BARE = re.compile(r"[^\s\"'`,;&<>]+")
_AT = re.compile(r"[(\[{](?:at|@)[)\]}]", re.I)
_HOST = re.compile(r" ?([A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*)")
_IBAN_GROUPS = re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:[ -][A-Z0-9]{4}){2,7}(?:[ -][A-Z0-9]{1,3})?(?![0-9A-Za-z])")
_GROUPS = re.compile(r"(?<![\w.,/(-])\(?[0-9][0-9()./-]*+(?: \(?[0-9][0-9()./-]*+)++")
_US_SHAPES = ((3, 3, 4), (3, 2, 4))
# A run starts behind any other character, so that the look-behind keeps the scan linear on long words.
_RUN = re.compile(r"(?<![0-9A-Za-zÀ-ɏ_.%+\-/()@])[A-Za-zÀ-ɏ_.%+\-/()]*+[0-9@][0-9A-Za-zÀ-ɏ_.%+\-/()@]*+")


def _trim(text: str, a: int, b: int) -> tuple[int, int]:
    while a < b and text[a] in _EDGE:
        a += 1
    while a < b and text[b - 1] in _EDGE:
        b -= 1
    return a, b


def _keyed(text: str):
    """Values of secret keys: up to the closing quote of the line, or to the next white space."""
    end, line = 0, -1
    for sign in _ASSIGN.finditer(text):
        at = sign.start()
        if at < end or text.startswith("//", at + 1):
            continue
        name = _NAME.search(text[max(0, at - 40) : at])
        if not name or name[1].lower() not in SECRET_KEYS:
            continue
        start = _GAP.match(text, at + 1).end()
        quote = text[start : start + 1]
        quoted = quote in ("'", '"', "`")
        if quoted:
            if line < start:
                line = text.find("\n", start)
                line = len(text) if line < 0 else line
            start += 1
            stop = text.find(quote, start, line)
        if not quoted or stop < 0:
            run = _BARE.match(text, start)
            if not run:
                continue
            start, stop = _trim(text, *run.span())
        plain = not _DIGIT.search(text, start, stop)
        if stop - start < (4 if plain else 2) or plain and not (quoted or sign[0] == "=" or name[1].lower() in PASSWORDS):
            continue
        yield start, stop
        end = stop


def _written_out(text: str):
    """Addresses whose ``@`` is written ``(at)`` or the like."""
    end = 0
    for at in _AT.finditer(text):
        a = b = at.start() - (text[at.start() - 1 : at.start()] == " ")
        while a > end and text[a - 1] in _LOCAL:
            a -= 1
        host = _HOST.match(text, at.end())
        if a < b and host:
            end = host.end()
            yield a, end


def _accounts(text: str):
    return (m.span() for m in _IBAN_GROUPS.finditer(text))


def _grouped(text: str):
    """Two to five groups of digits that make one number: a leading 0 or bracket, a cue before, or a known shape."""
    for m in _GROUPS.finditer(text):
        a, b = m.start(), m.end()
        while text[b - 1] in ".(/-":
            b -= 1
        parts = text[a:b].split(" ")
        sizes = tuple(sum(c.isdigit() for c in p) for p in parts)
        if 2 <= len(parts) <= 5 and 7 <= sum(sizes) <= 15:
            cue = {w.strip(_EDGE + "=").lower() for w in text[max(0, a - 48) : a].split()[-2:]} & (CONTACT_CUES | ID_CUES)
            if parts[0][0] in "0(" or cue or sizes in _US_SHAPES:
                yield a, b


def _runs(text: str):
    """Runs with a digit or an ``@`` between characters that no value holds (quotes, commas, ``?&=:``, other scripts)."""
    for m in _RUN.finditer(text):
        a, b = _trim(text, *m.span())
        if b - a >= 2:
            yield a, b


def blanked(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` with line breaks in place of spans; overlapping spans are allowed."""
    out, end = [], 0
    for a, b in sorted(spans):
        if b > end:
            a = max(a, end)
            out += [text[end:a], "\n" * (b - a)]
            end = b
    return "".join(out) + text[end:] if out else text


def candidates(text: str):
    """(start, end, value, key, two words before) in order of place, none overlapping another.

    The families are searched one after the other, each in what the earlier ones left; every scan
    is linear and values may have any length.
    """
    if not _HINT.search(text):
        return
    left, found = text, []
    for family in (_keyed, _written_out, _accounts, _grouped, _runs):
        spans = list(family(left))
        if spans:
            found += spans
            left = blanked(left, spans)
    for start, end in sorted(found):
        window = text[max(0, start - 48) : start]
        key = _KEY.search(window)
        yield start, end, text[start:end], key[1].lower() if key else "", window.split()[-2:]


def votes(value: str, key: str, before: list[str]) -> tuple[int, ...]:
    """1 personal, -1 not, 0 no opinion, of each labeler."""
    words = [w.strip(_EDGE + "=").lower() for w in before]
    digits = sum(c.isdigit() for c in value)
    near = {w for w in words if w} | ({key} if key else set())
    flat = value.replace(" ", "").replace("-", "")
    secret = 1 if _HEX.fullmatch(value) and digits and not value.isdigit() or _MIXED.fullmatch(value) and digits >= 3 or _IBAN.fullmatch(flat) else 0
    number = 1 if _NUMBER.fullmatch(value.replace(" ", "")) and 7 <= digits <= 19 else -1 if 0 < digits < 4 else 0
    small = -1 if _SMALL.fullmatch(value) else 0
    keyed = 1 if key in SECRET_KEYS else 0
    mail = 1 if _OBFUSCATED.fullmatch(value) or "@" in value and any(w in value.lower() for w in MAIL_WORDS) else 0
    cue = 1 if near & (CONTACT_CUES | ID_CUES | SECRET_KEYS) else 0
    benign = -1 if words and words[-1] in BENIGN_CUES or value.startswith(("/", "www.")) else 0
    return secret, number, small, keyed, mail, cue, benign


def features(value: str, key: str, before: list[str]) -> tuple[int, ...]:
    """Small integers that describe a span; each below 8, so that there is a bounded number of patterns."""
    digits, letters = sum(c.isdigit() for c in value), sum(c.isalpha() for c in value)
    n = len(value)
    near = {w.strip(_EDGE + "=").lower() for w in before} | {key}
    return (
        min(7, n.bit_length()), min(4, 4 * digits // n), min(4, 4 * letters // n), min(3, n - digits - letters),
        int("@" in value) + 2 * int(value[0] == "/") + 4 * int(_OBFUSCATED.fullmatch(value) is not None),
        3 if key in SECRET_KEYS else 2 if near & (CONTACT_CUES | ID_CUES) else 1 if key else 0,
        int(value.islower()) + 2 * int(value.isupper()),
    )


def kind_of(value: str) -> str:
    if "@" in value or _OBFUSCATED.fullmatch(value):
        return "contact"
    return "number" if not any(c.isalpha() for c in value) else "secret"


@dataclass(frozen=True)
class SpanModel:
    """Weights of one-hot span features; ``reliability`` holds P(vote | personal) and P(vote | not) by labeler."""

    weights: tuple[float, ...]
    bias: float
    reliability: dict
    threshold: float = 0.5

    def score(self, f: tuple[int, ...]) -> float:
        z = self.bias + sum(self.weights[8 * k + v] for k, v in enumerate(f))
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


N_FEATURES = 7


def vote_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(votes, features, n): how often each pattern occurs over all documents."""

    def count(batches):
        seen: Counter = Counter()
        for batch in pieces(batches):
            for text in batch.column(0).to_pylist():
                text = text or ""
                for _, _, value, key, before in candidates(blanked(text, [(a, b) for _, a, b in base_spans(text)])):
                    seen[votes(value, key, before), features(value, key, before)] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([list(v) for v, _ in seen], pa.list_(pa.int32())), pa.array([list(f) for _, f in seen], pa.list_(pa.int32())), pa.array(list(seen.values()), pa.int64())],
            names=["votes", "features", "n"],
        )

    found = docs.select(F.col(text_col)).mapInArrow(count, "votes array<int>, features array<int>, n long")
    return found.groupBy("votes", "features").agg(F.sum("n").alias("n"))


def aggregate_votes(v: np.ndarray, n: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, dict]:
    """EM over vote patterns (rows of ``v``, ``n`` times each): posterior of each row, reliabilities."""
    post = np.clip(0.3 + 0.35 * v.sum(1), 0.02, 0.98)
    table = {}
    for _ in range(rounds):
        prior = np.clip((n * post).sum() / n.sum(), 1e-4, 1 - 1e-4)
        yes, no = np.full(len(v), np.log(prior)), np.full(len(v), np.log(1 - prior))
        for k in range(v.shape[1]):
            for side, weight in (("yes", n * post), ("no", n * (1 - post))):
                table[k, side] = {x: (weight[v[:, k] == x].sum() + 1.0) / (weight.sum() + 3.0) for x in (-1, 0, 1)}
            for x in (1, -1):
                # a labeler may be useless but not turned round: its vote never counts against itself
                gain = np.log(table[k, "yes"][x] / table[k, "no"][x])
                gain = max(0.0, gain) if x == 1 else min(0.0, gain)
                yes = yes + np.where(v[:, k] == x, gain, 0.0)
        new = 1 / (1 + np.exp(np.clip(no - yes, -40, 40)))
        new = np.where(v.any(1), new, np.minimum(new, 0.02))
        if np.abs(new - post).max() < 1e-9:
            break
        post = new
    return post, {f"{LABELERS[k]}_{side}": t for (k, side), t in table.items()}


def fit_spans(docs: DataFrame, text_col: str = "text", steps: int = 400) -> SpanModel:
    """Reliabilities by EM over all documents, then the span classifier on the posteriors."""
    rows = vote_counts(docs, text_col).orderBy("votes", "features").collect()  # patterns: bounded by their ranges
    if not rows:
        return SpanModel((0.0,) * (8 * N_FEATURES), -4.0, {})
    v, f, n = np.array([r.votes for r in rows]), np.array([r.features for r in rows]), np.array([float(r.n) for r in rows])
    post, table = aggregate_votes(v, n)
    x = np.zeros((len(rows), 8 * N_FEATURES))
    for k in range(N_FEATURES):
        x[np.arange(len(rows)), 8 * k + f[:, k]] = 1.0
    w, b = np.zeros(x.shape[1]), 0.0
    share, g = n / n.sum(), np.full(x.shape[1] + 1, 1e-8)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w + b, -40, 40)))
        grad = np.append(x.T @ (share * (p - post)) + 1e-5 * w, (share * (p - post)).sum())
        g += grad**2
        move = 0.5 * grad / np.sqrt(g)
        w, b = w - move[:-1], b - move[-1]
    return SpanModel(tuple(np.round(w, 6)), float(round(b, 6)), table)


def all_spans(text: str, model: SpanModel, scores: dict | None = None) -> tuple[list, list]:
    """(base spans, added spans): candidates beside the base spans that the model accepts."""
    base = base_spans(text)
    added = []
    scores = {} if scores is None else scores
    for start, end, value, key, before in candidates(blanked(text, [(a, b) for _, a, b in base])):
        f = features(value, key, before)
        if f not in scores:
            scores[f] = model.score(f)
        if scores[f] >= model.threshold:
            added.append((kind_of(value), start, end))
    return base, sorted(added, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def joined(spans: list) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find_personal(docs: DataFrame, model: SpanModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans), one row per input row.

    ``n_spans`` counts base and added spans.  Spans count code points, ends excluded.  A null text counts as empty.  Repeated rows and
    null ids give a row each; other columns are not read; whole texts are searched.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    names = [f"n_{k}" for k in BASE] + ["base_sha256", "spans", "n_spans"]

    def make():
        scores: dict = {}

        def work(columns):
            rows = []
            for text in columns["text"].to_pylist():
                base, added = all_spans(text or "", model, scores)
                n = Counter(k for k, _, _ in base)
                rows.append((*(n[k] for k in BASE), hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + added), len(base) + len(added)))
            return {"id": columns["id"], **dict(zip(names, zip(*rows)))}

        return work

    schema = f"id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long"
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_rows(picked, schema, make).withColumnRenamed("id", id_col)


def masked(text: str, model: SpanModel, scores: dict | None = None) -> str:
    """``text`` with every span (overlapping ones together) replaced by ``[KIND]`` of the first."""
    base, added = all_spans(text, model, scores)
    out, end = [], 0
    for k, a, b in sorted(base + added, key=lambda s: (s[1], -s[2])):
        if a >= end:
            out += [text[end:a], f"[{k.upper()}]"]
        end = max(end, b)
    return "".join(out) + text[end:]


def mask_personal(docs: DataFrame, model: SpanModel, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with personal data masked in place and ``length_col`` set anew where a text changed."""
    names, schema = docs.columns, docs.schema
    at, long_at = names.index(text_col), names.index(length_col) if length_col in names else None

    def run(batches):
        scores: dict = {}
        for batch in pieces(batches):
            old = batch.column(at).to_pylist()
            new = [None if t is None else masked(t, model, scores) for t in old]
            arrays = list(batch.columns)
            arrays[at] = pa.array(new, arrays[at].type)
            if long_at is not None:
                sizes = [n if a == b else len(b) for a, b, n in zip(old, new, arrays[long_at].to_pylist())]
                arrays[long_at] = pa.array(sizes, arrays[long_at].type)
            yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

    return docs.mapInArrow(run, schema)

"""Personal data: patterns propose spans, checksums confirm, nearby words adjust the score.

Patterns run in Python on whole texts, each in time linear in the text (no pattern
rescans a run it has failed on), so one very long line cannot stall a task. Offsets
are code points, ends exclusive. Kinds in order: email, ip, card, phone, iban, ssn, secret.
A span's score is its kind's prior, raised by a context word of its kind in English, German,
French or Spanish that stands whole within CONTEXT_CHARS. The first four kinds are kept whenever their test holds
(parts at most 255, Luhn over 13 to 19 digits, 9 to 15 digits), whatever their score, and so
is iban, as mod-97 is test enough; an ssn, or a run of 20 letters and digits or more
that may be a secret, is kept from KEEP_FROM on, so context decides.

Edge cases: null or empty text has no spans; its redaction is null or empty as it
was. Rows are independent, so repeated rows get equal results; other columns pass
through whatever their names, except that `text` and, if it is there, `n_chars` are rewritten
by redact(); find_pii() adds its column under a free name.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .env import free, ship

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "secret")

SPANS_DDL = "array<struct<kind:string,start:int,end:int,score:double>>"

#: Words that, within CONTEXT_CHARS on either side, make a kind likelier. Fixed values.
CONTEXT = {
    "email": ("email", "e-mail", "mail", "contact", "kontakt", "courriel", "contacter", "correo", "contacto"),
    "ip": ("ip", "address", "host", "server", "adresse", "serveur", "dirección", "servidor"),
    "card": ("card", "credit", "visa", "mastercard", "payment", "karte", "kreditkarte", "carte", "paiement", "tarjeta", "pago"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "anruf", "handy", "téléphone", "appel", "teléfono", "llamar", "móvil"),
    "iban": ("iban", "account", "bank", "bic", "konto", "compte", "banque", "cuenta", "banco"),
    "ssn": ("ssn", "social", "security", "tax", "sozialversicherung", "steuer", "sécurité", "sociale", "seguridad", "impuesto"),
    "secret": ("token", "secret", "password", "passwd", "key", "api_key", "apikey", "bearer", "credential", "credentials", "passwort", "schlüssel", "geheim", "jeton", "clé", "mot de passe", "clave", "contraseña", "secreto"),
}
CONTEXT_CHARS, CONTEXT_GAIN, KEEP_FROM = 60, 0.2, 0.5
#: Scores of a span that passed its kind's test, before context. Fixed values.
PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.4, "secret": 0.3}

_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_SECRET = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_NEAR = {k: re.compile(r"\b(?:" + "|".join(map(re.escape, w)) + r")\b", re.IGNORECASE) for k, w in CONTEXT.items()}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        total += v if i % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str):
    floor = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            floor = m.end()
            yield start, m.end()


def _ips(text: str):
    for m in _IP.finditer(text):
        parts = m[0].split(".")
        if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in parts):
            yield m.span()


def _cards(text: str):
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def _phones(text: str):
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            yield m.span()


def _ibans(text: str):
    """From each start the longest run of whole words that holds the test; a start whose
    runs all fail gives way to the next one, so at most 34 characters are read of each."""
    at = 0
    while m := _IBAN.search(text, at):
        at = m.start() + 4
        ends = [i for i in range(m.start() + 15, m.end() + 1) if i == m.end() or text[i] == " "]
        for end in reversed(ends):
            plain = text[m.start():end].replace(" ", "")
            if 15 <= len(plain) <= 34 and mod97(plain):
                yield m.start(), end
                at = end
                break


def _ssns(text: str):
    for m in _SSN.finditer(text):
        yield m.span()


def _secrets(text: str):
    """Runs with letters and digits, of at least ten different characters."""
    for m in _SECRET.finditer(text):
        if len(set(m[0])) >= 10 and any(c.isdigit() for c in m[0]) and any(c.isalpha() for c in m[0]):
            yield m.span()


_PROPOSE = {"email": _emails, "ip": _ips, "card": _cards, "phone": _phones, "iban": _ibans, "ssn": _ssns, "secret": _secrets}


def _near(words: re.Pattern, text: str, start: int, end: int) -> bool:
    """Whether a context word stands whole within CONTEXT_CHARS before or after a span. The search begins
    inside the text, so that a word cut by the first character is none, and looks one character too far, so
    that one cut by the last is none either."""
    if words.search(text, max(0, start - CONTEXT_CHARS), start):
        return True
    after = words.search(text, end, end + CONTEXT_CHARS + 1)
    return after is not None and after.end() <= end + CONTEXT_CHARS


def spans_of(text: str | None) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) by kind, then start."""
    out = []
    for kind in KINDS if text else ():
        for start, end in _PROPOSE[kind](text):
            score = round(PRIOR[kind] + (CONTEXT_GAIN if _near(_NEAR[kind], text, start, end) else 0.0), 2)
            if kind in BASE_KINDS or score >= KEEP_FROM:
                out.append((kind, start, end, score))
    return out


def redacted(text: str | None) -> str | None:
    """The text with every span replaced by its kind in brackets; of spans that
    overlap, the earliest, then longest, names the whole."""
    found = sorted(spans_of(text), key=lambda s: (s[1], -s[2]))
    if not found:
        return text
    out, at = [], 0
    for kind, start, end, _ in found:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def find_spans(texts: pa.Array) -> pa.Array:
    offsets, kinds, starts, ends, scores = [0], [], [], [], []
    for t in texts:
        for kind, start, end, score in spans_of(t.as_py()):
            kinds.append(kind)
            starts.append(start)
            ends.append(end)
            scores.append(score)
        offsets.append(len(kinds))
    rows = pa.StructArray.from_arrays([pa.array(kinds, pa.string()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32()), pa.array(scores, pa.float64())], ["kind", "start", "end", "score"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows)


def redact_text(texts: pa.Array) -> pa.Array:
    return pa.array([redacted(t.as_py()) for t in texts], pa.string())


def find_pii(docs: DataFrame, text: str = "text", out: str = "pii") -> DataFrame:
    """Adds the array of spans, under the name out, or with underscores added to it if that is taken."""
    ship(docs.sparkSession)
    return docs.withColumn(*free(docs, out), F.arrow_udf(find_spans, SPANS_DDL)(F.col(f"`{text}`")))


def redact(docs: DataFrame) -> DataFrame:
    """docs with personal data in `text` replaced, `n_chars` recounted, same columns."""
    ship(docs.sparkSession)
    out = docs.withColumn("text", F.arrow_udf(redact_text, "string")(F.col("`text`")))
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

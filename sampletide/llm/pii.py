"""Personal data by weak supervision.

Task functions find candidate spans: those of four fixed patterns (the base) and looser ones (spelled-out mail
addresses, local phone numbers, card-like and address-like numbers in other groupings). Labelers of three kinds vote
on each candidate: patterns, gazetteers (top-level domains, issuer prefixes, reserved networks, area codes) and words
around it. Votes and shape bits are one small integer, so all candidates of the corpus aggregate to a table that is
bounded by the number of such integers. On that table expectation-maximisation estimates each labeler's reliability
per kind, and a logistic span classifier is trained on its posteriors with shape features added. A candidate beyond
the base becomes a span if the classifier accepts it; base spans always stay.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampletide.llm.common import mapped, travels

travels(__name__)

KINDS = ("email", "ip", "card", "phone")
# Labelers: 0 abstains, 1 says personal, 2 says not. Shape bits follow the votes in a pattern number.
LABELERS = ("pattern", "check", "gazetteer", "before", "after")
SHAPES = ("grouped", "bounded", "repeats", "short")
ACCEPT = 0.9
PATTERNS = 3 ** len(LABELERS) * 2 ** len(SHAPES)

# Gazetteers and context words, in four languages.
DOMAINS = frozenset("com org net edu gov mil int info biz io co us uk de fr es it nl be ch at ca au eu jp cn in br mx ru pl se".split())
CARD_PREFIXES = ("4", "51", "52", "53", "54", "55", "2221", "2720", "34", "37", "6011", "65", "35")
CUES = {
    "email": "email e-mail mail contact address write correo courriel adresse kontakt".split(),
    "ip": "ip host server address addr client from login hosts serveur servidor rechner".split(),
    "card": "card visa mastercard credit debit amex payment karte carte tarjeta zahlung paiement pago".split(),
    "phone": "phone tel telephone call mobile cell fax contact telefon telefono anruf appel llame movil".split(),
}
AGAINST = {
    "email": "example git version".split(),
    "ip": "version release section chapter build v kapitel abschnitt seccion".split(),
    "card": "isbn order invoice serial hash id sha key token number nr".split(),
    "phone": "isbn order invoice serial version page id total sum year".split(),
}

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SPELLED = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?(?:\[at\]|\(at\)|\{at\}) ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|\[dot\]|\(dot\)) ?[A-Za-z0-9-]{1,63}){1,8}", re.I)
_LOCAL_PHONE = re.compile(r"(?<![0-9+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")
_ANY = re.compile(r"[0-9@]|[\[({]at[\])}]", re.I)
_CUT = re.compile(r"[^\W\d_]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_emails(text: str):
    """Matches around each '@': the run of local characters before it, as far as the last match's end."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and _LOCAL.match(text[start - 1]):
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            end = m.end()
        else:
            end = max(end, at + 1)
        at = text.find("@", max(at + 1, end))


def base_ips(text: str):
    """Every four parts of a dotted run of numbers."""
    for m in _DOTTED.finditer(text):
        if m.group().count(".") < 3:
            continue
        at, parts = m.start(), m.group().split(".")
        for i in range(0, len(parts) - 3, 4):
            end = at + sum(map(len, parts[i:i + 4])) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts[i:i + 4]):
                yield at, end
            at = end + 1


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_cards(text: str):
    for m in _CARD.finditer(text):
        digits = digits_of(m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def base_phones(text: str):
    for m in _PHONE.finditer(text):
        if 8 <= len(digits_of(m.group())) <= 15:
            yield m.span()


def base(text: str) -> list[tuple[int, int, int]]:
    """Base spans (kind number, start, end) of a text, ordered by kind and start."""
    found = []
    if "@" in text:
        found += [(0, *s) for s in base_emails(text)]
    if "." in text:
        found += [(1, *s) for s in base_ips(text)]
    found += [(2, *s) for s in base_cards(text)]
    if "+" in text:
        found += [(3, *s) for s in base_phones(text)]
    return found


def looser(text: str):
    """Candidates beyond the base patterns."""
    if "at" in text or "AT" in text or "At" in text:
        yield from ((0, *m.span()) for m in _SPELLED.finditer(text))
    for m in _CARD.finditer(text):
        if 13 <= len(digits_of(m.group())) <= 19:
            yield 2, *m.span()
    yield from ((3, *m.span()) for m in _LOCAL_PHONE.finditer(text))


def candidates(text: str | None) -> list[tuple[int, int, int, int, bool]]:
    """(kind, start, end, pattern number, in base) of every candidate. Looser ones that touch a base span go."""
    if not text or not _ANY.search(text):
        return []
    found = base(text)
    taken = sorted((s, e) for _, s, e in found)
    rows, i = [(k, s, e, True) for k, s, e in found], 0
    last = -1
    for k, s, e in sorted(looser(text), key=lambda c: (c[1], -c[2])):
        while i < len(taken) and taken[i][1] <= s:
            i += 1
        if s >= last and not (i < len(taken) and taken[i][0] < e):
            rows.append((k, s, e, False))
            last = e
    return [(k, s, e, described(text, k, s, e, b), b) for k, s, e, b in rows]


def described(text: str, kind: int, start: int, end: int, strict: bool) -> int:
    """Votes of the labelers and shape bits of one candidate as one number below PATTERNS."""
    span, digits = text[start:end], digits_of(text[start:end])
    name = KINDS[kind]
    before = [w.lower() for w in _CUT.findall(text[max(0, start - 48):start])][-4:]
    after = [w.lower() for w in _CUT.findall(text[end:end + 32])][:2]
    if kind == 0:
        check = 1 if len(span) <= 254 and ".." not in span else 2
        last = re.split(r"[^A-Za-z0-9-]+", span)[-1].lower()
        listed = 1 if last in DOMAINS else 0
    elif kind == 1:
        parts = [int(p.lstrip("0") or 0) for p in span.split(".")]
        check = 1 if not any(len(p) > 1 and p[0] == "0" for p in span.split(".")) else 2
        listed = 2 if parts[0] in (0, 127) or parts[0] >= 224 else 1
    elif kind == 2:
        check = 1 if luhn(digits) else 2
        listed = 1 if digits.startswith(CARD_PREFIXES) else 2
    else:
        check = 1 if 8 <= len(digits) <= 15 else 0
        listed = 1 if strict and digits[:1] != "0" else 0
    votes = [1 if strict else 0, check, listed,
             1 if set(before) & set(CUES[name]) else 2 if set(before) & set(AGAINST[name]) else 0,
             1 if set(after) & set(CUES[name]) else 0]
    inside = span[1:-1]
    shapes = [any(c in " -().[]{}" for c in inside),
              not (text[start - 1:start].isalnum() or text[end:end + 1].isalnum()),
              len(set(digits)) <= 2, len(span) < 12]
    number = 0
    for v in votes:
        number = number * 3 + v
    for b in shapes:
        number = number * 2 + bool(b)
    return number


def unpacked(number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Votes (rows x labelers) and shape bits (rows x shapes) of pattern numbers."""
    shapes = np.stack([(number >> (len(SHAPES) - 1 - i)) & 1 for i in range(len(SHAPES))], 1)
    rest = number >> len(SHAPES)
    votes = np.stack([rest // 3 ** (len(LABELERS) - 1 - i) % 3 for i in range(len(LABELERS))], 1)
    return votes, shapes


def expectation_maximisation(votes: np.ndarray, count: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of 'personal' per vote pattern, and (class, labeler, vote) reliabilities. Starts from the vote share;
    pseudo-counts keep every labeler better than chance to begin with and the two classes from changing places."""
    for_, against = (votes == 1).sum(1), (votes == 2).sum(1)
    post = (for_ + 0.5) / (for_ + against + 1.0)
    prior = np.array([[1.0, 0.5, 2.0], [1.0, 2.0, 0.5]])  # not personal, personal: abstain, for, against
    table = np.zeros((2, votes.shape[1], 3))
    for _ in range(rounds):
        for c, w in enumerate((count * (1 - post), count * post)):
            for j in range(votes.shape[1]):
                table[c, j] = np.bincount(votes[:, j], w, 3) + 4 * prior[c]
                table[c, j] /= table[c, j].sum()
        share = np.clip((count @ post + 1) / (count.sum() + 2), 0.01, 0.99)
        score = np.log(share / (1 - share))
        for j in range(votes.shape[1]):
            score = score + np.log(table[1, j, votes[:, j]] / table[0, j, votes[:, j]])
        post = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
    return post, table


def logistic(x: np.ndarray, target: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Weighted ridge logistic regression on soft targets by Newton steps."""
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (target - p)) - ridge * beta
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta))
        step = np.linalg.solve(bend, slope)
        beta = beta + np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def features(number: np.ndarray) -> np.ndarray:
    votes, shapes = unpacked(number)
    return np.hstack([np.ones((len(number), 1)), votes == 1, votes == 2, shapes]).astype(float)


def pattern_counts(docs: DataFrame) -> DataFrame:
    """kind, pattern, n over all candidates of all texts: at most 4 x PATTERNS rows."""
    def task(columns):
        counts: dict = {}
        for text in columns["text"].to_pylist():
            for k, _, _, p, _ in candidates(text):
                counts[k, p] = counts.get((k, p), 0) + 1
        return {"kind": [k for k, _ in counts], "pattern": [p for _, p in counts], "n": list(counts.values())}
    return (mapped(docs.select("text"), task, "kind int, pattern int, n long")
            .groupBy("kind", "pattern").agg(F.sum("n").alias("n")))


def train(counts: DataFrame) -> dict[tuple[int, int], float]:
    """Probability of each (kind, pattern) that occurs. What is collected is bounded by 4 x PATTERNS rows."""
    rows = np.array([(r.kind, r.pattern, r.n) for r in counts.collect()], dtype=np.int64).reshape(-1, 3)
    model = {}
    for kind in range(len(KINDS)):
        own = rows[rows[:, 0] == kind]
        if len(own):
            post, _ = expectation_maximisation(unpacked(own[:, 1])[0], own[:, 2].astype(float))
            x = features(own[:, 1])
            beta = logistic(x, post, own[:, 2] / own[:, 2].sum() * 200)
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            model.update(((kind, int(n)), float(v)) for n, v in zip(own[:, 1], p, strict=True))
    return model


def kept_spans(found, model) -> list[tuple[int, int, int]]:
    return sorted((k, s, e) for k, s, e, p, b in found if b or model.get((k, p), 0.0) >= ACCEPT)


def joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def _found(docs: DataFrame) -> DataFrame:
    """doc_id, list of candidates: a few numbers per document, without the text."""
    def task(columns):
        found = [candidates(t) for t in columns["text"].to_pylist()]
        return {"doc_id": columns["doc_id"],
                "found": [[{"kind": k, "start": s, "stop": e, "pattern": p, "base": b} for k, s, e, p, b in f] for f in found]}
    return mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), task,
                  "doc_id long, found array<struct<kind:int,start:long,stop:long,pattern:int,base:boolean>>")


def find(docs: DataFrame, written) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans: one row per row of `docs`.

    Null and empty texts have no spans; ids may be null or repeat; other columns are not read. An empty table gives
    an empty result. Texts are read once: candidates are written, their patterns counted, and scored from there.
    """
    found = written(_found(docs), "pii-candidates")
    one = found.select(F.explode("found").alias("c")).select("c.kind", "c.pattern")
    model = train(one.groupBy("kind", "pattern").agg(F.count("*").alias("n")))

    def task(columns):
        out = {c: [] for c in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_spans")}
        for row in columns["found"].to_pylist():
            tuples = [(c["kind"], c["start"], c["stop"], c["pattern"], c["base"]) for c in row]
            base_ = sorted(c[:3] for c in tuples if c[4])
            spans = kept_spans(tuples, model)
            for k, name in enumerate(KINDS):
                out[f"n_{name}"].append(sum(b[0] == k for b in base_))
            out["base_sha256"].append(hashlib.sha256(joined(base_).encode()).hexdigest())
            out["spans"].append(joined(spans))
            out["n_spans"].append(len(spans))
        return out | {"doc_id": columns["doc_id"]}
    return mapped(found, task, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
                               "spans string, n_spans long")


def redact(docs: DataFrame) -> DataFrame:
    """`docs` with each span of `text` replaced by its kind in angle brackets; n_chars, where there is one, follows.

    Same model and spans as `find`. All columns stay; a null text stays null.
    """
    model = train(pattern_counts(docs))
    schema, place = docs.schema, {c: i for i, c in enumerate(docs.columns)}
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)

    def masked(text):
        if not text:
            return text
        out, at = [], 0
        for k, s, e in sorted(kept_spans(candidates(text), model), key=lambda x: (x[1], -x[2])):
            if e > at:
                out += [text[at:max(s, at)], f"<{KINDS[k]}>"]
                at = e
        return "".join(out) + text[at:] if out else text

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            texts = batch.column(place["text"]).to_pylist()
            new = [masked(t) for t in texts]
            cols = [batch.column(i) for i in range(batch.num_columns)]
            cols[place["text"]] = pa.array(new, arrow.field(place["text"]).type)
            if "n_chars" in place:
                kept = cols[place["n_chars"]].to_pylist()
                cols[place["n_chars"]] = pa.array([k if a is b else len(b) for k, a, b in zip(kept, texts, new, strict=True)],
                                                  arrow.field(place["n_chars"]).type)
            yield pa.RecordBatch.from_arrays(cols, schema=arrow)
    return docs.mapInArrow(run, schema)

"""Personal data by patterns, made consistent by a skip-chain conditional random field.

*Base* spans are the leftmost non-overlapping matches of each kind (email, ip, card, phone) that
pass its check: parts at most 255, 12 to 19 digits and Luhn's sum, 9 to 15 digits.

*Skip-chain CRF.*  The nodes of a document are its tokens ``[^\\x20\\x09-\\x0D]+`` with a digit or an
``@``; the labels are the kinds and "none".  Potentials:

* observation: the token's shape, as log-likelihood ratios learned from all documents, with the
  base spans as labels (shapes and cues are a short fixed list, so the model is a small table);
* chain: between neighbouring nodes, from the counts of their label pairs;
* skip: between a token and its next occurrence in the document, equal or alike
  (same digits, same address), ``SKIP`` for agreeing on a kind.  One edge to the next
  occurrence keeps the edges linear in the text and still connects all occurrences.

Loopy sum-product message passing, damped, runs until the messages rest or ``ROUNDS`` are over.  Nodes in a base
span are held at its kind.  A token outside all base spans whose marginal for a kind is at least
``SURE`` becomes an added span of that kind, without the punctuation around it.

Edge cases: null or empty text has no span.  Rows that repeat an id are judged one by
one.  Offsets count code points, ends are exclusive.  All patterns run in linear time, also on long
runs of digits or of letters.  An empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm import text as tx
from tideline.llm.common import pick

KINDS = ("email", "ip", "card", "phone")
LABELS = (None, *KINDS)
SKIP = 4.0
SURE = 0.9
ROUNDS = 30
DAMP = 0.3
HELD = 50.0  # log potential of a base label

LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
# a match can begin inside a run of digits only if it can at the run's begin: looking there alone is linear
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
DIGITS = re.compile(r"[0-9]")
CUES = {"email": "mail", "mail": "mail", "e-mail": "mail", "ip": "ip", "host": "ip", "card": "card", "visa": "card",
        "tel": "phone", "phone": "phone", "call": "phone"}


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses, in time linear in the text."""
    out, free = [], 0
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > free and not NOT_LOCAL.match(text[begin - 1]):
            begin -= 1
        m = DOMAIN.match(text, at + 1) if begin < at else None
        if m:
            out.append((begin, m.end()))
            free = m.end()
        else:
            free = max(free, at)
        at = text.find("@", max(at + 1, free))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def _part(p: str) -> bool:
    p = p.lstrip("0") or "0"
    return len(p) <= 3 and int(p) <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(begin, kind, end)`` of the base matches, in order; kind is its place in ``KINDS``."""
    out = [(b, 0, e) for b, e in emails(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(map(_part, m.groups()))]
    for m in CARD.finditer(text):
        if m.end() - m.start() <= 37:  # 19 digits with a separator between all
            digits = "".join(DIGITS.findall(m[0]))
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(DIGITS.findall(m[0])) <= 15]
    return sorted(out)


class Graph:
    """The nodes of one document: place, shape, likeness key and base label."""

    def __init__(self, text: str, spans: list[tuple[int, int, int]]):
        self.begin, self.end, self.shapes, self.keys, self.chain, labels = [], [], [], [], [], []
        before, place, last = "", 0, -2
        ordered, s = spans, 0
        for m in TOKEN.finditer(text):
            token = m[0]
            if "@" in token or DIGITS.search(token):
                core = token.strip(".,;:!?\"'()[]{}<>")
                digits = "".join(DIGITS.findall(token))
                self.begin.append(m.start() + (token.find(core) if core else 0))
                self.end.append(self.begin[-1] + len(core))
                self.shapes.append(self.shape(token, core, digits, before))
                self.keys.append(core.lower() if "@" in token else digits if len(digits) >= 6 else core)
                if last == place - 1:
                    self.chain.append(len(self.begin) - 2)
                last = place
                while s < len(ordered) and ordered[s][2] <= m.start():
                    s += 1
                found = [k for b, k, e in ordered[max(s - 4, 0) : s + 4] if b < m.end() and e > m.start()]
                labels.append(found[0] + 1 if found else 0)
            before, place = token, place + 1
        self.labels = np.array(labels, np.int64)

    @staticmethod
    def shape(token: str, core: str, digits: str, before: str) -> tuple[str, ...]:
        n = len(digits)
        size = str(n) if n < 12 else ("luhn" if n <= 19 and luhn(digits) else "long") if n <= 19 else "huge"
        parts = core.split(".")
        dotted = "quad" if len(parts) == 4 and all(p.isdigit() and p.isascii() and _part(p) for p in parts) else str(min(len(parts), 5))
        mail = "none" if "@" not in token else "mail" if DOMAIN.search(token.partition("@")[2]) else "at"
        plain = "digits" if core.isdigit() else "marks" if not re.search("[A-Za-z]", core) else "letters"
        left = "plus" if before[:1] == "+" else "area" if re.fullmatch(r"\([0-9]+\)", before) else \
            CUES.get(before.lower().rstrip(":"), "other")
        return (f"size={size}", f"dots={dotted}", f"mail={mail}", f"form={plain}",
                f"first={token[0] if token[0] in '+(' else 'x'}", f"left={left}")

    def skips(self) -> list[tuple[int, int]]:
        """Each node and the next one alike."""
        seen: dict[str, int] = {}
        out = []
        for i, k in enumerate(self.keys):
            if k in seen:
                out.append((seen[k], i))
            seen[k] = i
        return out


def likely(column) -> list[int]:
    """The texts with a digit or an ``@``; all others have no nodes."""
    table = np.zeros(256, bool)
    table[[*range(0x30, 0x3A), 0x40]] = True
    out = []
    for first, _, data, offsets in tx.slices(column):
        hit = np.flatnonzero(table[data])
        out += (np.unique(np.searchsorted(offsets, hit, side="right") - 1) + first).tolist()
    return out


def learn(docs: DataFrame) -> dict:
    """Log potentials of shapes and of neighbouring labels, from the counts over all documents."""

    def count(batches):
        for batch in batches:
            seen: Counter = Counter()
            for i in likely(batch.column(0)):
                text = batch.column(0)[i].as_py()
                g = Graph(text, base_spans(text))
                for shape, y in zip(g.shapes, g.labels.tolist()):
                    seen["label", y] += 1
                    for f in shape:
                        seen[f, y] += 1
                for i in g.chain:
                    seen[f"pair={g.labels[i]}", int(g.labels[i + 1])] += 1
            yield pa.RecordBatch.from_pydict(
                {"f": [k[0] for k in seen], "y": [k[1] for k in seen], "n": list(seen.values())},
                schema=pa.schema([("f", pa.string()), ("y", pa.int32()), ("n", pa.int64())]))

    rows = (docs.select("text").mapInArrow(count, "f string, y int, n long")
            .groupBy("f", "y").agg(F.sum("n").alias("n")).collect())  # a fixed list of shapes by five labels
    n = {(r["f"], r["y"]): r["n"] for r in rows}
    total = np.array([n.get(("label", y), 0) for y in range(len(LABELS))], float)
    prior = np.log((total + 0.5) / (total.sum() + 0.5 * len(LABELS)))
    values = Counter(f.partition("=")[0] for f in {f for f, _ in n})
    shapes = {}
    for f in {f for f, _ in n if "=" in f and not f.startswith("pair=")}:
        got = np.array([n.get((f, y), 0) for y in range(len(LABELS))], float)
        shapes[f] = np.log((got + 0.5) / (total + 0.5 * (values[f.partition("=")[0]] + 1)))
    pair = np.array([[n.get((f"pair={a}", b), 0) + 0.5 for b in range(len(LABELS))] for a in range(len(LABELS))], float)
    joint = pair / pair.sum()
    chain = np.log(joint / (joint.sum(1, keepdims=True) * joint.sum(0, keepdims=True)))
    return {"prior": prior, "shapes": shapes, "chain": chain}


def marginals(g: Graph, model: dict) -> np.ndarray:
    """Label probabilities of each node by loopy sum-product message passing."""
    n, k = len(g.begin), len(LABELS)
    node = np.tile(model["prior"], (n, 1))
    for i, shape in enumerate(g.shapes):
        for f in shape:
            if f in model["shapes"]:
                node[i] += model["shapes"][f]
    held = np.flatnonzero(g.labels)
    node[held, g.labels[held]] += HELD
    skip = np.zeros((k, k))
    skip[np.arange(1, k), np.arange(1, k)] = SKIP
    ends = [(i, i + 1) for i in g.chain] + g.skips()
    if ends:
        pots = np.stack([model["chain"]] * len(g.chain) + [skip] * (len(ends) - len(g.chain)))
        a, b = np.array(ends).T
        source, target = np.concatenate([a, b]), np.concatenate([b, a])
        pots = np.concatenate([pots, pots.transpose(0, 2, 1)])  # by source label, then target label
        back = (np.arange(len(source)) + len(a)) % len(source)
        msg = np.zeros((len(source), k))
        for _ in range(ROUNDS):
            belief = node.copy()
            np.add.at(belief, target, msg)
            out = np.logaddexp.reduce((belief[source] - msg[back])[:, :, None] + pots, axis=1)
            out -= np.logaddexp.reduce(out, axis=1, keepdims=True)
            out = DAMP * msg + (1 - DAMP) * out
            rest = np.abs(out - msg).max()
            msg = out
            if rest < 1e-4:
                break
        np.add.at(node, target, msg)
    return np.exp(node - np.logaddexp.reduce(node, axis=1, keepdims=True))


def added_spans(text: str, spans: list[tuple[int, int, int]], model: dict) -> list[tuple[int, int, int]]:
    g = Graph(text, spans)
    if not len(g.labels) or not (g.labels == 0).any():
        return []
    p = marginals(g, model)
    best = p[:, 1:].argmax(axis=1)
    sure = (p[np.arange(len(p)), best + 1] >= SURE) & (g.labels == 0)
    return [(g.begin[i], int(best[i]), g.end[i]) for i in np.flatnonzero(sure).tolist() if g.end[i] > g.begin[i]]


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: ``doc_id, spans``, each span with ``kind, start, stop, base``, in order."""
    docs = pick(docs, doc_id=id_col, text=text_col)
    model = docs.sparkSession.sparkContext.broadcast(learn(docs))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("base", pa.bool_())]))

    def find(batches):
        for batch in batches:
            out: list[list] = [[] for _ in range(len(batch))]
            for i in likely(batch.column(1)):
                text = batch.column(1)[i].as_py()
                spans = base_spans(text)
                every = [(*s, True) for s in spans] + [(*s, False) for s in added_spans(text, spans, model.value)]
                out[i] = [{"kind": KINDS[k], "start": b, "stop": e, "base": base} for b, k, e, base in sorted(every)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], names=["doc_id", "spans"])

    of_id = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(find, f"doc_id {of_id}, spans array<struct<kind: string, start: long, stop: long, base: boolean>>")

"""Personal data: exact base patterns and a skip-chain conditional random field.

The base finds e-mail and IP addresses, card and phone numbers by pattern. The random
field adds what the patterns miss. Its nodes are the words with a digit or "@"; nodes
that follow each other in a text are joined by chain edges, nodes with the same
characters are joined to one hub for all of them, and every node is joined to the last
one before it of the same shape, however distant (skip edges). The edges of a text grow
with its nodes, not their square.

Weights (shape features, one table of label pairs per kind of edge) are trained by
pseudo-likelihood on the base labels of a bounded sample of documents. In a text, nodes
inside base spans keep their label, which their hub has too, and loopy belief propagation
carries it along the edges until the messages settle, so that a repeated word gets the
same evidence however often and far away it stands.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfline.llm.common import Scratch, bounded_sample, map_arrow, prepare

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
#: Documents the field is trained on, and the most nodes one of them may have.
SAMPLE, SAMPLE_NODES = 2000, 200
FEATURE_BITS = 12
#: Characters of the texts whose graphs are worked on together.
GRAPH_CHARS = 1 << 20
#: Messages have settled when none changes by more; they stop after ROUNDS if they never do.
SETTLED, ROUNDS = 1e-3, 200
#: Least marginal probability of an added span.
SURE = 0.9

# The base patterns. None of them can start inside a run of its first
# class after failing at the run's start, so looking back spares long runs.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_MARK = re.compile(r"[0-9@]")
_EDGE = "\"'`()[]{}<>.,;:!?"


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+, found from each "@"."""
    spans, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            spans.append((start, end))
            at = text.find("@", end)
        else:
            # The characters before a failed "@" cannot belong to a later match.
            end = at + 1
            at = text.find("@", at + 1)
    return spans


def passes_luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Base matches by kind, leftmost and without overlap; a match that fails its test is dropped."""
    spans: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if not _MARK.search(text):
        return spans
    spans["email"] = emails(text)
    # A number of more than 255 has a digit beyond three that are not leading zeros; long ones are not converted.
    small = lambda part: len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255
    spans["ip"] = [m.span() for m in _IP.finditer(text) if all(small(p) for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and passes_luhn(digits):
                spans["card"].append(m.span())
    for m in _PHONE.finditer(text):
        if 8 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
            spans["phone"].append(m.span())
    return spans


@dataclass
class Graph:
    """Nodes of some texts: span, owner, base label (-1: none known), hashed features; edges (one, two, kind). A hub has no features."""

    spans: list[tuple[int, int]]
    owner: list[int]
    label: np.ndarray
    features: list[list[int]]
    edges: np.ndarray


CHAIN, SAME, SHAPE = range(3)
#: Words between two nodes that still count as neighbours.
_REACH = 3


def _shape(word: str) -> str:
    """Classes of characters, runs shortened to one, at most 12."""
    out = []
    for c in word:
        k = "9" if "0" <= c <= "9" else "a" if c.isalpha() else c
        if not out or out[-1] != k:
            out.append(k)
        if len(out) == 12:
            break
    return "".join(out)


def _hashed(*names: str) -> list[int]:
    return [int.from_bytes(hashlib.blake2b(n.encode(), digest_size=4).digest()) % (1 << FEATURE_BITS) for n in names]


def graph_of(texts: list[tuple[str, dict[str, list[tuple[int, int]]]]]) -> Graph:
    """One graph for some texts and their base spans."""
    spans, owner, label, features, edges = [], [], [], [], []
    for number, (text, base) in enumerate(texts):
        known = sorted((a, b, 1 + k) for k, kind in enumerate(KINDS) for a, b in base[kind])
        at, last, last_place = 0, -1, 0
        by_text: dict[str, list[int]] = {}
        by_shape: dict[str, int] = {}
        previous = ""
        for place, m in enumerate(_WORD.finditer(text)):
            word = m.group()
            if not _MARK.search(word):
                previous = word
                continue
            core = word.strip(_EDGE) or word
            start = m.start() + word.find(core)
            span = (start, start + len(core))
            while at < len(known) and known[at][1] <= span[0]:
                at += 1
            inside = next((k for a, b, k in known[at : at + 2] if a < span[1] and b > span[0]), 0)
            node, shape = len(spans), _shape(core)
            digits = sum("0" <= c <= "9" for c in core)
            spans.append(span)
            owner.append(number)
            label.append(inside)
            features.append(_hashed("bias", f"shape:{shape}", f"digits:{min(digits, 24)}", f"both:{shape}:{min(digits, 24)}", f"length:{min(len(core), 40) // 4}", f"before:{_shape(previous)}"))
            if last >= 0 and place - last_place <= _REACH:
                edges.append((last, node, CHAIN))
            by_text.setdefault(core.lower(), []).append(node)
            alike = f"{shape}:{digits}"
            if alike in by_shape:
                edges.append((by_shape[alike], node, SHAPE))
            by_shape[alike] = node
            last, last_place, previous = node, place, word
        for same in by_text.values():
            if len(same) > 1:
                # The hub has the label of its nodes; it is unknown if they have none or several.
                kinds = {label[node] for node in same} - {0}
                edges += [(node, len(spans), SAME) for node in same]
                spans.append((0, 0))
                owner.append(number)
                label.append(kinds.pop() if len(kinds) == 1 else 0)
                features.append([])
    return Graph(spans, owner, np.array(label, np.int64), features, np.array(edges, np.int64).reshape(-1, 3))


@dataclass
class Field:
    """Weights: features x labels, and a symmetric table of label pairs for each kind of edge."""

    unary: np.ndarray
    pairs: np.ndarray


def train(graphs: list[Graph], rounds: int = 300, rate: float = 0.5, decay: float = 1e-4) -> Field:
    """Maximise the pseudo-likelihood of the base labels by gradient ascent from zero.

    A node without a label that a skip edge joins to one with a label may be just what the
    patterns miss: it is unknown, and teaches nothing. Hubs only lend their label to their nodes.
    """
    n = len(LABELS)
    field = Field(np.zeros((1 << FEATURE_BITS, n)), np.zeros((3, n, n)))
    row, column, label, one, two, kind = [], [], [], [], [], []
    nodes = 0
    for g in graphs:
        for i, f in enumerate(g.features):
            row += [nodes + i] * len(f)
            column += f
        label.append(g.label)
        one.append(g.edges[:, 0] + nodes)
        two.append(g.edges[:, 1] + nodes)
        kind.append(g.edges[:, 2])
        nodes += len(g.features)
    if not nodes:
        return field
    row, column, label = np.array(row), np.array(column), np.concatenate(label)
    one, two, kind = (np.concatenate(x) for x in (one, two, kind))
    target = np.eye(n)[label]
    known = np.zeros((nodes, 1))
    known[row] = 1
    for a, b in ((one, two), (two, one)):
        known[a[(kind != CHAIN) & (label[a] == 0) & (label[b] > 0)]] = 0
    # Step sizes follow each weight's own gradients, so rare features are learned too.
    seen_unary, seen_pairs = np.full(field.unary.shape, 1e-8), np.full(field.pairs.shape, 1e-8)
    for _ in range(rounds):
        logits = np.zeros((nodes, n))
        np.add.at(logits, row, field.unary[column])
        np.add.at(logits, one, field.pairs[kind, :, label[two]])
        np.add.at(logits, two, field.pairs[kind, label[one], :])
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=1, keepdims=True)
        off = (target - p) * known / nodes
        step = -decay * field.unary
        np.add.at(step, column, off[row])
        pair_step = np.zeros_like(field.pairs)
        np.add.at(pair_step, (kind, slice(None), label[two]), off[one])
        np.add.at(pair_step, (kind, label[one], slice(None)), off[two])
        pair_step = pair_step + pair_step.transpose(0, 2, 1) - decay * field.pairs
        seen_unary += step**2
        seen_pairs += pair_step**2
        field.unary += rate * step / np.sqrt(seen_unary)
        field.pairs += rate * pair_step / np.sqrt(seen_pairs)
    return field


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def marginals(field: Field, g: Graph, rounds: int = ROUNDS) -> np.ndarray:
    """Label probabilities of every node by loopy belief propagation; base labels are given.

    The messages of each text are passed until they have settled, whatever other texts the graph holds.
    """
    n = len(LABELS)
    own = np.zeros((len(g.features), n))
    for i, f in enumerate(g.features):
        own[i] = field.unary[f].sum(axis=0)
    given = g.label > 0
    own[given] = np.where(np.eye(n)[g.label[given]] > 0, 0.0, -1e3)
    one, two, kind = g.edges.T
    source, target = np.concatenate((one, two)), np.concatenate((two, one))
    back = np.concatenate((np.arange(len(one)) + len(one), np.arange(len(one))))
    text = np.array(g.owner, np.int64)[source] if len(g.owner) else np.zeros(len(source), np.int64)
    # One table of label pairs for each kind of edge and direction.
    tables = np.concatenate((field.pairs, field.pairs.transpose(0, 2, 1)))
    which = np.concatenate((kind, kind + len(field.pairs)))
    message = np.zeros((len(source), n))
    moving = np.arange(len(source))
    for _ in range(rounds):
        if not len(moving):
            break
        belief = own.copy()
        np.add.at(belief, target, message)
        coming = belief[source[moving]] - message[back[moving]]
        out = np.empty_like(coming)
        for table in np.unique(which[moving]).tolist():
            mine = which[moving] == table
            for label in range(n):
                out[mine, label] = _log_sum(coming[mine] + tables[table][:, label], axis=1)
        out -= out.max(axis=1, keepdims=True)
        change = np.zeros(int(text.max()) + 1)
        np.maximum.at(change, text[moving], np.abs(out - message[moving]).max(axis=1))
        message[moving] = 0.5 * message[moving] + 0.5 * out
        moving = moving[change[text[moving]] >= SETTLED]
    belief = own.copy()
    np.add.at(belief, target, message)
    belief -= belief.max(axis=1, keepdims=True)
    p = np.exp(belief)
    return p / p.sum(axis=1, keepdims=True)


def learn(docs: DataFrame) -> Field:
    """Train on at most SAMPLE different documents with nodes (the first by a hash of id and text, at most SAMPLE_NODES nodes each).

    Their hashes are found first, without the texts; then the texts are fetched by the hashes.
    """
    scratch = Scratch(prepare(docs.sparkSession), "private-data")

    def usable(batch: pa.RecordBatch) -> dict:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        marked = [sum(1 for w in _WORD.finditer(t) if _MARK.search(w.group())) if _MARK.search(t) else 0 for t in texts]
        return {"order": batch.column(0), "use": [0 < n <= SAMPLE_NODES for n in marked]}

    rows = docs.select(F.xxhash64("doc_id", "text").alias("order"), "text").where(F.col("text").rlike("[0-9@]"))
    orders = scratch.write(map_arrow(rows, usable, "order long, use boolean").where("use").select("order").distinct(), "orders")
    chosen = scratch.write(bounded_sample(orders, F.col("order"), SAMPLE), "chosen")
    # At most SAMPLE hashes are broadcast, and of copies of one row one is taken.
    sample = rows.join(F.broadcast(chosen), "order", "left_semi").groupBy("order").agg(F.min("text").alias("text"))
    # Bounded: SAMPLE texts' graphs. They are built on the executors and only numbers come back.
    def numbers(batch: pa.RecordBatch) -> dict:
        g = graph_of([(t, base_spans(t)) for t in batch.column(0).to_pylist()])
        flat = [np.array([len(f), *f], "<i4") for f in g.features]
        return {"label": [g.label.astype("<i4").tobytes()], "features": [np.concatenate(flat).tobytes()], "edges": [g.edges.astype("<i4").tobytes()]}

    graphs = []
    for r in map_arrow(sample.select("text"), numbers, "label binary, features binary, edges binary").collect():
        flat, features, at = np.frombuffer(r["features"], "<i4").tolist(), [], 0
        while at < len(flat):
            features.append(flat[at + 1 : at + 1 + flat[at]])
            at += 1 + flat[at]
        graphs.append(Graph([], [], np.frombuffer(r["label"], "<i4").astype(np.int64), features, np.frombuffer(r["edges"], "<i4").astype(np.int64).reshape(-1, 3)))
    return train(graphs)


def _runs(sizes: list[int]) -> Iterator[range]:
    """Runs of texts of about GRAPH_CHARS characters; a longer text stands alone, since its nodes depend on each other."""
    start, size = 0, 0
    for i, n in enumerate(sizes):
        if i > start and size + n > GRAPH_CHARS:
            yield range(start, i)
            start, size = i, 0
        size += n
    if sizes:
        yield range(start, len(sizes))


def find_private(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    The counts and ``base_sha256`` (of kind:start:end by kind and start, comma-joined) are
    the base's; ``spans`` lists all spans in the same form, places in code points with the
    end exclusive. A null text is empty. Repeated rows are judged one by one; only doc_id
    and text are read. ``field`` is trained on the documents if it is not given.
    """
    field = learn(docs) if field is None else field
    shared = prepare(docs.sparkSession).sparkContext.broadcast(field)

    def joined(spans: dict[str, list[tuple[int, int]]]) -> str:
        return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in sorted(spans[k]))

    def find(batch: pa.RecordBatch) -> dict:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        base = [base_spans(t) for t in texts]
        whole = [{k: list(v) for k, v in b.items()} for b in base]
        marked = [i for i, t in enumerate(texts) if _MARK.search(t)]
        added = [0] * len(texts)
        for some in _runs([len(texts[i]) for i in marked]):
            some = [marked[k] for k in some]
            g = graph_of([(texts[i], base[i]) for i in some])
            if not len(g.label) or (g.label > 0).all():
                continue
            p = marginals(shared.value, g)
            best = p[:, 1:].argmax(axis=1)
            for node in np.flatnonzero((g.label == 0) & (p[:, 1:].max(axis=1) >= SURE)).tolist():
                if not g.features[node]:
                    continue
                i = some[g.owner[node]]
                whole[i][KINDS[best[node]]].append(g.spans[node])
                added[i] += 1
        out = {f"n_{k}": np.array([len(b[k]) for b in base], np.int64) for k in KINDS}
        return {
            "doc_id": batch.column(0), **out,
            "base_sha256": [hashlib.sha256(joined(b).encode()).hexdigest() for b in base],
            "spans": [joined(w) for w in whole], "n_added": np.array(added, np.int64),
        }

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(
        docs.select("doc_id", "text"), find, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
    )

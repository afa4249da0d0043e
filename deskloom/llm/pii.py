"""Personal data with a skip-chain conditional random field.

Fixed patterns find the certain spans. A CRF over the other mentions (runs of digit groups, words around an at sign or what
stands for one) labels the rest: neighbouring mentions are linked as in a chain, and equal or similar ones far apart (the same
last digits, the same letters) share a skip potential, so that what is known at one place of a document counts at the others.
Weights are learned together from the certain spans and from copies of their texts in which they are spelled otherwise.
Loopy message passing settles the labels of all documents of a batch at once.
"""

import re
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskloom.llm.words import slices

# Executors need not have this package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

KINDS = ("email", "ip", "card", "phone")
LABELS = ("other", *KINDS)

# The patterns of the four kinds. An address is looked for around each @ and a number from where its digits
# begin, which finds what a scan from every position finds, in linear time.
LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CANDIDATE = re.compile("[0-9@]")
NOT_DIGITS = re.compile("[^0-9]+")


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return (sum(values[::2]) + sum(2 * v - 9 * (v > 4) for v in values[1::2])) % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_PART:
            start -= 1
        match = DOMAIN.match(text, at) if start < at else None
        if match:
            found.append((start, match.end()))
        done = match.end() if match else at + 1
        at = text.find("@", done)
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of the certain spans, in order."""
    if not CANDIDATE.search(text):
        return []
    found = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = NOT_DIGITS.sub("", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(NOT_DIGITS.sub("", m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


# Mentions that can be personal data in another spelling: runs of digit groups, and words around an at sign or a stand-in.
RUN = re.compile(r"\+?\(?[0-9]++(?:[\x20().\-/\[\]]{1,3}+[0-9]++)*+")
GROUP = re.compile(r"[0-9]+")
DENSE = re.compile("[./-]")
AT = re.compile(r"\x20?@\x20?|\x20?[\[({]\x20?at\x20?[\])}]\x20?|\x20at\x20", re.I)
HOST = re.compile(r"[A-Za-z0-9-]++(?:(?:\.|\x20?[\[({]\x20?dot\x20?[\])}]\x20?|\x20dot\x20)[A-Za-z0-9-]++)++", re.I)
HEDGED = re.compile("[\\[({\x20](at|dot)[\\])}\x20]", re.I)
SIGNS = re.compile("[^A-Za-z0-9]+")
PLACE = re.compile("[@0-9]|[\\[({\x20]at[\\])}\x20]", re.I)


@dataclass(frozen=True)
class CrfRules:
    features: int = 1 << 12    # hashed
    rounds: int = 12           # of message passing
    damping: float = 0.5
    least: float = 0.6         # marginal probability of a label that adds a span
    skip_digits: int = 7       # last digits that two numbers must share to be linked over a distance
    near: int = 40             # code points between mentions that are neighbours in the chain
    sample_docs: int = 6000    # most documents that the weights are learned from
    sample_chars: int = 20_000 # longer documents are labelled whole, but not learned from
    clamp: float = 30.0        # log potential that holds mentions of certain spans


@dataclass
class Crf:
    unary: np.ndarray   # features x labels
    chain: np.ndarray   # labels x labels, of neighbouring mentions
    skip: np.ndarray    # of equal or similar mentions far apart


@dataclass
class Graph:
    """Mentions of several texts as nodes, with their links."""

    text: list          # number of the text
    span: list          # (start, end)
    active: list        # feature numbers
    label: list         # number of the label that a certain span gives, 0 for none
    chain: list         # (node, next node)
    skip: list


def number_runs(text: str):
    """(start, end) of runs of digit groups. A lone space parts two runs where one side is long or written without spaces."""
    for m in RUN.finditer(text):
        groups = [(g.start() + m.start(), g.end() + m.start()) for g in GROUP.finditer(m[0])]
        gaps = [text[x[1]:y[0]] for x, y in zip(groups, groups[1:])]
        first = 0
        for i, gap in enumerate(gaps):
            if gap != " ":
                continue
            head = i == 0 and m[0][0] == "+"
            long = groups[i + 1][1] - groups[i + 1][0] >= 7 or (not head and groups[i][1] - groups[i][0] >= 7)
            dense = not head and any(0 <= j < len(gaps) and DENSE.search(gaps[j]) for j in (i - 1, i + 1))
            word = i == 0 and m.start() > 0 and text[m.start() - 1].isalnum()  # the first digits end a word
            if long or dense or word:
                yield (m.start() if first == 0 else groups[first][0]), groups[i][1]
                first = i + 1
        yield (m.start() if first == 0 else groups[first][0]), m.end()


def address_runs(text: str):
    """(start, end) of what may be an address, whether its signs are written or spelled."""
    done = 0
    for m in AT.finditer(text):
        start = m.start()
        while start > done and text[start - 1] in LOCAL_PART:
            start -= 1
        host = HOST.match(text, m.end()) if start < m.start() else None
        if host and ("@" in m[0] or m[0].strip() != m[0].strip().strip("[](){}") or " dot " in host[0].lower()):
            yield start, host.end()
            done = host.end()


def mentions(text: str) -> list[tuple[int, int, bool]]:
    """(start, end, whether an address), in order; numbers inside an address are no mentions."""
    if not PLACE.search(text):
        return []
    found, at = [(a, b, True) for a, b in address_runs(text)], 0
    addresses = list(found)
    for a, b in number_runs(text):
        while at < len(addresses) and addresses[at][1] <= a:
            at += 1
        if at == len(addresses) or addresses[at][0] >= b:
            if "(" in text[a:b] and ")" not in text[a:b]:
                a = text.index("(", a) + 1 if text[a] == "(" else a
            found.append((a, b, False))
    return sorted(found)


def facts(text: str, start: int, end: int, address: bool) -> tuple[str, ...]:
    piece = text[start:end]
    sizes = [g.end() - g.start() for g in GROUP.finditer(piece)]
    digits = NOT_DIGITS.sub("", piece)
    glued = any(0 <= i < len(text) and (text[i].isalnum() or text[i] in "_@\"=") for i in (start - 1, end))
    if address:
        digits, sizes, form = "", [], "address " + ("spelled" if HEDGED.search(piece) else "signs")
    else:
        form = "layout " + "-".join(map(str, sizes[:8]))
    signs = "".join(sorted(set(SIGNS.sub(" ", "") if address else "".join(c for c in piece if not c.isdigit()))))
    four = len(sizes) == 4 and all(int(g[0][-4:]) <= 255 and len(g[0]) <= 3 for g in GROUP.finditer(piece))
    before = text[max(0, start - 24):start].lower().split()
    kind = ("address" if address else "card" if 14 <= len(digits) <= 19 and luhn(digits) else "four" if four
            else "number" if 10 <= len(digits) <= 15 else "short")
    return ("bias", form, f"{form} {glued}", f"signs {signs}", f"digits {min(len(digits), 20)}", f"kind {kind} {glued}",
            f"kind {kind} in {min(len(sizes), 6)}", "before " + (before[-1].strip(".,:;()") if before else ""))


def add_text(graph: Graph, number: int, text: str, certain: list, rules: CrfRules) -> None:
    last_seen: dict[str, int] = {}
    at, before = 0, -1
    for start, end, address in mentions(text):
        while at < len(certain) and certain[at][2] <= start:
            at += 1
        label = next((k + 1 for a, k, b in certain[at:at + 4] if a < end and b > start), 0)
        node = len(graph.span)
        graph.text.append(number)
        graph.span.append((start, end))
        graph.active.append([xxhash.xxh3_64_intdigest(f) % rules.features for f in facts(text, start, end, address)])
        graph.label.append(label)
        if before >= 0 and start - before <= rules.near:
            graph.chain.append((node - 1, node))
        before = end
        piece = text[start:end]
        digits = NOT_DIGITS.sub("", piece)
        key = SIGNS.sub("", HEDGED.sub("", piece)).lower() if address else digits[-rules.skip_digits:]
        if address or len(key) == rules.skip_digits:
            if key in last_seen:  # similar mentions form a chain of their own: links stay linear in the length of the text
                graph.skip.append((last_seen[key], node))
            last_seen[key] = node


def graph_of(texts: list[str], certain: list[list], rules: CrfRules) -> Graph:
    graph = Graph([], [], [], [], [], [])
    for number, (text, spans) in enumerate(zip(texts, certain)):
        add_text(graph, number, text, spans, rules)
    return graph


def respelled(kind: int, piece: str, turn: int) -> str:
    """The same datum in another spelling."""
    groups = GROUP.findall(piece)
    digits = "".join(groups)
    if kind == 0:
        at, dot = ((" [at] ", " [dot] "), ("(at)", "."), (" at ", " dot "), (" @ ", "."), ("[at]", "[dot]"), ("{at}", "."))[turn % 6]
        local, host = piece.split("@", 1)
        return local + at + host.replace(".", dot)
    if kind == 1:
        return ("[.]", " . ", "-", "(.)")[turn % 4].join(groups)
    if kind == 2:
        sign = (".", " ", "-", "/")[turn % 4]
        return sign.join(digits[i:i + 4] for i in range(0, len(digits), 4))
    local = digits[-10:]
    x, y, z = local[:3], local[3:6], local[6:]
    country = digits[:-10] or "1"
    return (f"{x}-{y}-{z}", f"({x}) {y}-{z}", f"{x}.{y}.{z}", f"{x} {y} {z}", f"{country}-{x}-{y}-{z}", f"00{country} {x} {y} {z}",
            f"+{country}/{x}/{y}/{z}", f"({x}){y}-{z}", f"{x}/{y}-{z}", f"{country} ({x}) {y}-{z}")[turn % 10]


def unlike(piece: str, turn: int) -> str:
    """Digits of the same look that are nothing personal: numbers of items, dates, amounts, hex strings, versions."""
    digits = (NOT_DIGITS.sub("", piece) + "20314159265358979")[:17]
    day, month = int(digits[:2]) % 28 + 1, int(digits[2:4]) % 12 + 1
    return (f"{2000 + day}-{month:02}-{day:02}", digits[:10], digits[:7] + "." + digits[7:9], "f" + digits[:16] + "c", digits[:8],
            f"{digits[:3]}.{digits[3]}.{digits[4]}", f"{day:02}/{month:02}/{2000 + month}", f"{digits[:2]} {digits[2:5]} {digits[5:8]}",
            digits[:12], f"978-{digits[0]}-{digits[1:5]}-{digits[5:9]}-{digits[9]}", f"{2000 + day}-{2001 + day}", digits[:11])[turn % 12]


def lessons(text: str) -> list[tuple[str, list, list]]:
    """(text, spans known to be personal, spans known to be nothing) of the text as it is and with its data respelled, repeated
    in other spellings at the end, and replaced by numbers of the same look. What may be personal without a certain span is in
    neither list."""
    certain = [c for i, c in enumerate(base_spans(text)) if i < 64]
    doubtful = [(a, b) for a, b, address in mentions(text) if address or len(NOT_DIGITS.sub("", text[a:b])) >= 7]
    told = [(a, 0, b) for a, b, _ in mentions(text) if (a, b) not in set(doubtful)
            and not any(x < b and y > a for x, _, y in certain)]
    made = [(text, certain, told)]
    turn = xxhash.xxh3_64_intdigest(text)
    for copy in range(4 if certain else 0):
        parts, spans, none, done, size = [], [], [], 0, 0
        for i, (a, k, b) in enumerate(certain):
            if a < done:
                continue
            new = text[a:b] if copy == 3 else respelled(k, text[a:b], turn + i + copy) if copy < 2 else unlike(text[a:b], turn + i)
            parts += [text[done:a], new]
            size += a - done
            (none if copy == 2 else spans).append((size, k, size + len(new)))
            size, done = size + len(new), b
        parts.append(text[done:])
        size += len(text) - done
        if copy == 3:
            for i, (a, k, b) in enumerate(certain):
                bare = NOT_DIGITS.sub("", text[a:b])
                new = bare[-10:] if k == 3 and i % 2 else bare if k == 3 else respelled(k, text[a:b], turn + i)
                parts += [" and, ", new]
                spans.append((size + 6, k, size + 6 + len(new)))
                size += 6 + len(new)
        made.append(("".join(parts), spans, none))
    return made


def train(texts: list[str], rules: CrfRules = CrfRules(), steps: int = 500, rate: float = 3.0, ridge: float = 2e-5) -> Crf:
    """Unary, chain and skip weights, learned together by pseudo-likelihood from the certain spans and their respellings."""
    taught = [x for t in texts for x in lessons(t)]
    graph = graph_of([t for t, _, _ in taught], [sorted(s) for _, s, _ in taught], rules)
    size = len(LABELS)
    unary, chain, skip = np.zeros((rules.features, size)), np.zeros((size, size)), np.zeros((size, size))
    if not graph.span:
        return Crf(unary, chain, skip)
    labels = np.array(graph.label)
    told = np.array([any(a < e and b > s for a, _, b in taught[t][2]) for t, (s, e) in zip(graph.text, graph.span)])
    known = (labels > 0) | told
    share = np.bincount(labels[known], minlength=size)
    weight = np.where(known, 1 / np.sqrt(np.maximum(share, 1))[labels], 0.0)
    weight /= max(weight.sum(), 1e-9)
    goal, active = np.eye(size)[labels], np.array(graph.active)
    hot = goal * known[:, None]  # a neighbour without a known label says nothing

    def sides(links):
        pairs = np.array(links, np.int64).reshape(-1, 2)
        return np.concatenate([pairs, pairs[:, ::-1]]).T

    tables, ends = [chain, skip], [sides(graph.chain), sides(graph.skip)]
    for _ in range(steps):
        z = unary[active].sum(axis=1)
        for table, (a, b) in zip(tables, ends):
            np.add.at(z, a, hot[b] @ table)
        z = np.exp(z - z.max(axis=1, keepdims=True))
        error = (z / z.sum(axis=1, keepdims=True) - goal) * weight[:, None]
        slope = np.zeros_like(unary)
        np.add.at(slope, active, error[:, None, :])
        unary -= rate * (slope + ridge * unary)
        for table, (a, b) in zip(tables, ends):
            turn = hot[b].T @ error[a]
            table -= 4 * rate * (turn + turn.T + ridge * table)
    return Crf(unary, chain, skip)


def marginals(graph: Graph, crf: Crf, rules: CrfRules) -> np.ndarray:
    """Label probabilities of all nodes by damped sum-product message passing on the loopy graph."""
    potential = crf.unary[np.array(graph.active)].sum(axis=1)
    labels = np.array(graph.label)
    held = labels > 0
    potential[held] = -rules.clamp
    potential[held, labels[held]] = rules.clamp
    links = np.array([*graph.chain, *graph.skip], np.int64).reshape(-1, 2)
    table = np.concatenate([np.repeat(crf.chain[None], len(graph.chain), 0), np.repeat(crf.skip[None], len(graph.skip), 0)])
    source, target = np.concatenate([links[:, 0], links[:, 1]]), np.concatenate([links[:, 1], links[:, 0]])
    table = np.concatenate([table, table])  # the tables are symmetric
    back = np.concatenate([np.arange(len(links)) + len(links), np.arange(len(links))])
    messages = np.zeros((len(source), len(LABELS)))
    for _ in range(rules.rounds if len(links) else 0):
        belief = potential.copy()
        np.add.at(belief, target, messages)
        z = (belief[source] - messages[back])[:, :, None] + table
        top = z.max(axis=1)
        new = top + np.log(np.exp(z - top[:, None, :]).sum(axis=1))
        new -= new.max(axis=1, keepdims=True)
        messages = rules.damping * messages + (1 - rules.damping) * new
    np.add.at(potential, target, messages)
    p = np.exp(potential - potential.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def plausible(kind: int, piece: str) -> bool:
    """Whether a mention can be what its label says."""
    groups = GROUP.findall(piece)
    digits = "".join(groups)
    if kind == 0:
        return AT.search(piece) is not None
    if kind == 1:
        return len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups)
    return 14 <= len(digits) <= 19 and luhn(digits) if kind == 2 else 7 <= len(digits) <= 15


def added_spans(texts: list[str], certain: list[list], crf: Crf, rules: CrfRules) -> list[list[tuple[int, int, int]]]:
    """For every text the spans that the CRF adds; none overlaps a certain one."""
    added: list[list] = [[] for _ in texts]
    graph = graph_of(texts, certain, rules)
    if not graph.span:
        return added
    p = marginals(graph, crf, rules)
    best = p.argmax(axis=1)
    chosen = (best > 0) & (p.max(axis=1) >= rules.least) & (np.array(graph.label) == 0)
    for node in np.flatnonzero(chosen).tolist():
        (start, end), number, kind = graph.span[node], graph.text[node], int(best[node]) - 1
        if plausible(kind, texts[number][start:end]):
            added[number].append((start, kind, end))
    return added


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: CrfRules = CrfRules()) -> Crf:
    """A CRF learned from at most ``sample_docs`` different texts of at most ``sample_chars`` code points: those with the
    smallest hashes among the ones with a digit or an at sign. Null ids and repeated rows take no more places than others."""
    rows = docs.select(F.col(text_col).cast("string").alias("text"))
    usable = rows.filter(F.col("text").rlike("[0-9@]") & (F.length("text") <= rules.sample_chars))
    keyed = usable.select(F.xxhash64("text").alias("h"), "text")
    lowest = keyed.select("h").distinct().orderBy("h").limit(rules.sample_docs)
    edge = lowest.agg(F.max("h")).first()[0]
    if edge is None:
        return train([], rules)
    found = keyed.filter(F.col("h") <= edge).groupBy("h").agg(F.min("text").alias("text")).orderBy("h").limit(rules.sample_docs)
    return train([r["text"] for r in found.collect()], rules)


def personal_data(docs: DataFrame, crf: Crf, id_col: str = "doc_id", text_col: str = "text",
                  rules: CrfRules = CrfRules()) -> DataFrame:
    """One row per input row: doc_id, n_email, n_ip, n_card, n_phone and base_spans (certain ones), spans (all), n_added.

    Spans are ``kind:start:end`` in code points, by start. Null and empty texts have none; repeated rows and null ids give a
    row each.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shared = spark.sparkContext.broadcast((crf.unary, crf.chain, crf.skip))  # plain arrays: workers need not have this package
    names = [f"n_{k}" for k in KINDS]

    def search(batches):
        model = Crf(*shared.value)
        for part in slices(batches, 1 << 20):
            texts = [t or "" for t in part.column(1).to_pylist()]
            certain = [base_spans(t) for t in texts]
            added = added_spans(texts, certain, model, rules)
            counts = [[sum(k == kind for _, k, _ in spans) for spans in certain] for kind in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(map(written, certain), pa.string()),
                 pa.array([written(sorted(a + b)) for a, b in zip(certain, added)], pa.string()),
                 pa.array(map(len, added), pa.int64())],
                names=["doc_id", *names, "base_spans", "spans", "n_added"])

    return rows.mapInArrow(search, f"doc_id {dict(rows.dtypes)['doc_id']}, " + ", ".join(f"{n} bigint" for n in names)
                           + ", base_spans string, spans string, n_added bigint")


"""Toxicity by a learned lexicon, its misspellings, and the context of each hit.

Learning: whole words and word beginnings are counted in labelled toxic and clean documents; a
greedy cover keeps the few entries that explain the toxic ones. The entries form a trie. A word
is matched by running the Levenshtein automata of all entries at once: a state is a set of
(trie node, errors), made when it is first needed, so a word costs one look-up a letter.

Scoring: a hit has the precision that its kind had in the labelled documents (exact entry, or
misspelling). Quotation marks or reporting verbs in the window before a hit make it weaker. The
score of a text is 1 - (1 - p0) * product(1 - p) over its distinct terms, with p0 the share of
toxic documents without any hit.

Defined cases: an absent or empty text gets p0; an absent label is not used; rows of one id with
several labels count as toxic if one does; repeated rows are scored as often as they occur;
without toxic labels the lexicon is empty.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from versemill.llm.common import appended, schema_with, without

LETTERS = re.compile(r"[^\W\d_]+")
#: At most about so many labelled rows are used for fitting, drawn by a digest of the id.
MAX_LABELLED = 200_000
#: At most so many words or beginnings, the best by evidence, are offered to the cover.
MAX_CANDIDATES = 20_000
MIN_TOXIC = 5
MIN_LOG_ODDS = 3.0
PREFIXES = range(4, 8)
#: Window before a hit, in words, in which quotation marks and reporting verbs are looked for.
CONTEXT = 12
QUOTED = 0.3
REPORTING = 0.6
QUOTES = re.compile("[\"“”„«»]")
OPENING, CLOSING = "„«", "”»"
REPORTING_VERBS = frozenset(
    "said says wrote writes called quote quoted quotes reported reporting alleged citing"
    " dijo escribió llamó cita sagte schrieb nannte zitierte dit écrit appelé cite".split()
)
#: Prior belief in misspellings of an entry, in documents: of three, so many were toxic. The
#: misspellings seen of an entry are in turn the prior of each single one, as so many documents.
NEAR_PRIOR = (2.0, 3.0)
NEAR_WEIGHT = 3.0
#: Toxic documents that an entry must explain for each clean one that has it.
CLEAN_COST = 4
FLUSH = 400_000


def allowed_errors(entry: str) -> int:
    """Edits by which a word may miss an entry; a beginning (ending in *) must be exact."""
    return 0 if entry.endswith("*") or len(entry) < 5 else 1 if len(entry) < 9 else 2


class LexiconAutomaton:
    """The Levenshtein automata of all entries run along their common trie.

    A state is the set of (node, errors, allowed errors of the best entry below) that the letters
    read so far can lead to. States and steps are made on demand and kept.
    """

    def __init__(self, entries: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.word_at: dict[int, str] = {}
        self.start_at: dict[int, str] = {}
        self.budget: list[int] = [0]
        for entry in entries:
            node, most = 0, allowed_errors(entry)
            self.budget[0] = max(self.budget[0], most)
            for ch in entry.rstrip("*"):
                nxt = self.children[node].get(ch)
                if nxt is None:
                    nxt = self.children[node][ch] = len(self.children)
                    self.children.append({})
                    self.budget.append(0)
                node = nxt
                self.budget[node] = max(self.budget[node], most)
            (self.start_at if entry.endswith("*") else self.word_at)[node] = entry
        self.letters = {ch for nodes in self.children for ch in nodes}
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.accepts: list[tuple[str, int] | None] = []
        self.begins: list[str | None] = []
        self.first = self._state({(0, 0)})

    def _state(self, pairs: set[tuple[int, int]]) -> int:
        """The state of these pairs and of those that skip letters of an entry."""
        best: dict[int, int] = {}
        todo = list(pairs)
        while todo:
            node, errors = todo.pop()
            if errors > self.budget[node] or best.get(node, 99) <= errors:
                continue
            best[node] = errors
            todo += [(child, errors + 1) for child in self.children[node].values()]
        key = frozenset(best.items())
        number = self.states.get(key)
        if number is None:
            number = self.states[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
            ends = sorted(
                (errors, self.word_at[node])
                for node, errors in key
                if node in self.word_at and errors <= allowed_errors(self.word_at[node])
            )
            self.accepts.append((ends[0][1], ends[0][0]) if ends else None)
            starts = sorted(self.start_at[node] for node, errors in key if errors == 0 and node in self.start_at)
            self.begins.append(starts[0] if starts else None)
        return number

    def _step(self, state: int, ch: str) -> int:
        pairs = set()
        for node, errors in self.sets[state]:
            for letter, child in self.children[node].items():
                pairs.add((child, errors + (letter != ch)))
            pairs.add((node, errors + 1))
        return self._state(pairs)

    def match(self, word: str) -> tuple[str, int] | None:
        """(entry, edits) of the nearest entry, the first one of equals; None without one."""
        state, begun = self.first, None
        for ch in word:
            if ch not in self.letters:
                ch = ""
            nxt = self.steps[state].get(ch)
            if nxt is None:
                nxt = self.steps[state][ch] = self._step(state, ch)
            state = nxt
            begun = begun or self.begins[state]
            if not self.sets[state]:
                break
        end = self.accepts[state]
        if end and (end[1] == 0 or not begun):
            return end
        return (begun, 0) if begun else end


class Memory(dict):
    """word → match, for words seen before; emptied when large."""

    def __init__(self, automaton: LexiconAutomaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: str):
        if len(self) > 500_000:
            self.clear()
        out = self[word] = self.automaton.match(word) if len(word) > 3 else None
        return out


@dataclass
class Model:
    """entries: p by exact entry; near: p by misspelling as written; others have that of the
    entry's misspellings together (`near_entry`)."""

    entries: dict[str, float] = field(default_factory=dict)
    near: dict[str, float] = field(default_factory=dict)
    near_entry: dict[str, float] = field(default_factory=dict)
    base: float = 0.0


def in_quotes(text: str, start: int, memory: int = 400) -> bool:
    """Whether a quotation opened in the text before `start` is still open there."""
    marks = QUOTES.findall(text, max(0, text.rfind("\n", 0, start) + 1, start - memory), start)
    return bool(marks) and (marks[-1] in OPENING or (marks[-1] not in CLOSING and sum(m not in OPENING + CLOSING for m in marks) % 2 == 1))


def hits_of(text: str, memory: Memory) -> list[tuple[str, str, int, float]]:
    """(entry, word, edits, factor of the context) for each distinct entry, its strongest use."""
    lowered = text.lower()
    words = LETTERS.findall(lowered)
    found = [(i, word, hit) for i, word in enumerate(words) if (hit := memory[word])]
    if not found:
        return []
    spans = [m.span() for m in LETTERS.finditer(lowered)]
    best: dict[str, tuple[str, str, int, float]] = {}
    for i, word, (entry, errors) in found:
        reported = any(w in REPORTING_VERBS for w in words[max(0, i - CONTEXT) : i])
        factor = QUOTED if in_quotes(lowered, spans[i][0]) else REPORTING if reported else 1.0
        old = best.get(entry)
        if old is None or (-errors, factor) > (-old[2], old[3]):
            best[entry] = (entry, word, errors, factor)
    return list(best.values())


def score_text(hits: list[tuple[str, str, int, float]], model: Model) -> float:
    clean = 1.0 - model.base
    for entry, word, errors, factor in hits:
        p = model.entries[entry] if errors == 0 else model.near.get(word, model.near_entry.get(entry, 0.0))
        clean *= 1.0 - p * factor
    return 1.0 - clean


def _labelled(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str, text: str, most: int) -> DataFrame:
    """(toxic, text) of the rows to learn from. Of more than `most` labels, a share is drawn."""
    known = (
        labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter("_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    n = known.count()
    if n > most:
        known = known.filter(F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) < int((1 << 20) * most / n))
    # Bounded by `most` (two numbers a row), so it can be sent to all tasks.
    rows = docs.filter(learn).select(F.col(id_col).alias("_id"), F.col(text).cast("string").alias("text"))
    return rows.join(F.broadcast(known), "_id").select("toxic", "text")


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    toxic: Counter[str] = Counter()
    clean: Counter[str] = Counter()

    def flush():
        names = list(toxic.keys() | clean.keys())
        yield pa.RecordBatch.from_pydict(
            {
                "feature": pa.array(names, pa.string()),
                "a": pa.array([toxic[x] for x in names], pa.int64()),
                "b": pa.array([clean[x] for x in names], pa.int64()),
            }
        )
        toxic.clear()
        clean.clear()

    for batch in batches:
        for label, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist()):
            words = {w for w in LETTERS.findall((text or "").lower()) if 3 < len(w) < 40}
            starts = {w[:k] + "*" for w in words for k in PREFIXES if len(w) > k}
            (toxic if label else clean).update(words | starts)
            if len(toxic) + len(clean) > FLUSH:
                yield from flush()
    yield from flush()


def _hit_batches(entries: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = Memory(LexiconAutomaton(entries))
        for batch in batches:
            hits = [hits_of(t or "", memory) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {
                    "toxic": batch.column("toxic").cast(pa.int32()),
                    "exact": pa.array([sorted(h[0] for h in x if not h[2]) for x in hits], pa.list_(pa.string())),
                    "near": pa.array([sorted(f"{h[0]} {h[1]}" for h in x if h[2]) for x in hits], pa.list_(pa.string())),
                }
            )

    return run


def _exact_batches(entries: frozenset[str]):
    """Which candidate words and beginnings each text has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = []
            for text in batch.column("text").to_pylist():
                words = {w for w in LETTERS.findall((text or "").lower()) if 3 < len(w) < 40}
                starts = {w[:k] + "*" for w in words for k in PREFIXES if len(w) > k}
                held.append(sorted((words | starts) & entries))
            yield pa.RecordBatch.from_pydict(
                {"toxic": batch.column("toxic").cast(pa.int32()), "held": pa.array(held, pa.list_(pa.string()))}
            )

    return run


def _cover(groups: list[tuple[int, frozenset[str], int]]) -> list[str]:
    """Entries by greedy cover: each must explain MIN_TOXIC more toxic documents than it costs
    clean ones CLEAN_COST times over. Of equals a whole word wins, for it is matched with misspellings,
    then the longer, then the last."""
    open_groups = groups
    chosen: list[str] = []
    while True:
        gain: Counter[str] = Counter()
        for toxic, held, n in open_groups:
            for entry in held:
                gain[entry] += n if toxic else -CLEAN_COST * n
        best = max(gain, key=lambda e: (gain[e], not e.endswith("*"), len(e), e), default=None)
        if best is None or gain[best] < MIN_TOXIC:
            return chosen
        chosen.append(best)
        open_groups = [g for g in open_groups if best not in g[1]]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text: str = "text",
    max_labelled: int = MAX_LABELLED,
    max_candidates: int = MAX_CANDIDATES,
) -> Model:
    """Learn entries and their precisions from the labelled rows where `learn` holds.

    `max_labelled` bounds the rows that are learnt from, and so what comes to the driver: the
    candidates (`max_candidates`), and for each combination of them its number of documents.
    """
    sample = _labelled(docs, labels, learn, id_col, text, max_labelled)
    totals = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic:
        return Model()
    counts = sample.mapInArrow(_count_features, "feature string, a long, b long").groupBy("feature").agg(
        F.sum("a").alias("a"), F.sum("b").alias("b")
    )
    odds = F.log((F.col("a") + 0.5) / (toxic + 1)) - F.log((F.col("b") + 0.5) / (clean + 1))
    strong = counts.withColumn("odds", odds).filter((F.col("a") >= MIN_TOXIC) & (F.col("odds") >= MIN_LOG_ODDS))
    rows = strong.orderBy(F.desc(F.col("a") * F.col("odds")), "feature").limit(max_candidates).collect()
    candidates = frozenset(r["feature"] for r in rows)
    if not candidates:
        return Model(base=toxic / (toxic + clean))
    held = sample.mapInArrow(_exact_batches(candidates), "toxic int, held array<string>")
    groups = held.filter("size(held) > 0").groupBy("toxic", "held").agg(F.count("*").alias("n")).collect()
    entries = _cover([(r["toxic"], frozenset(r["held"]), r["n"]) for r in groups])
    if not entries:
        return Model(base=toxic / (toxic + clean))
    # What the chosen entries and their misspellings are worth, each in the documents that hold it.
    seen = sample.mapInArrow(_hit_batches(entries), "toxic int, exact array<string>, near array<string>")
    seen = seen.groupBy("toxic", "exact", "near").agg(F.count("*").alias("n")).collect()
    exact, near, rest = {e: [0, 0] for e in entries}, {}, [0, 0]
    of_entry = {e: [0, 0] for e in entries}
    for r in seen:
        for e in r["exact"]:
            exact[e][r["toxic"]] += r["n"]
        if not r["exact"]:
            for pair in r["near"]:
                near.setdefault(pair, [0, 0])[r["toxic"]] += r["n"]
                of_entry[pair.split(" ")[0]][r["toxic"]] += r["n"]
            if not r["near"]:
                rest[r["toxic"]] += r["n"]
    a, b = NEAR_PRIOR
    near_entry = {e: (t + a) / (c + t + b) for e, (c, t) in of_entry.items()}
    believed = {pair: near_entry[pair.split(" ")[0]] * NEAR_WEIGHT for pair in near}
    return Model(
        entries={e: (t + 1.0) / (c + t + 2.0) for e, (c, t) in exact.items()},
        near={pair.split(" ")[1]: (t + believed[pair]) / (c + t + NEAR_WEIGHT) for pair, (c, t) in near.items()},
        near_entry=near_entry,
        base=(rest[1] + 0.1) / (sum(rest) + 1.0),
    )


def _score_batches(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = Memory(LexiconAutomaton(sorted(model.entries)))
        for batch in batches:
            scores = [score_text(hits_of(t or "", memory), model) for t in batch.column("_scored_text").to_pylist()]
            yield appended(batch.drop_columns(["_scored_text"]), score=pa.array(scores, pa.float64()))

    return run


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All rows and columns of `docs` and `score` (0 to 1). A column of that name is replaced."""
    kept = without(docs, "score")
    source = kept.withColumn("_scored_text", F.col(text).cast("string"))
    return source.mapInArrow(_score_batches(model), schema_with(kept, "score double"))

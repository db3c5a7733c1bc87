"""Toxicity by a weighted grammar: transducers over the words of a clause, and learned word stems."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace
from functools import cached_property

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealtide.llm.tables import keep, prepare_python

# Words of the grammar. Insults and threats have weights until labels give better ones: a
# lone word is far from toxic.
INSULTS = dict.fromkeys((
    "asshole", "bastard", "bitch", "clown", "coward", "cretin", "degenerate", "disgusting", "dumbass", "filth",
    "freak", "garbage", "idiot", "imbecile", "jerk", "loser", "lowlife", "maggot", "moron", "parasite", "pathetic",
    "pig", "retard", "scum", "scumbag", "slut", "stupid", "trash", "ugly", "vermin", "whore", "worthless",
), 1.0)
THREATS = dict.fromkeys(("behead", "burn", "destroy", "hang", "hurt", "kill", "lynch", "murder", "rape", "shoot", "stab"), 0.75)
#: Threats with harmless senses: they need a modal before them to be directed.
HARMS = frozenset(("burn", "destroy", "hang", "hurt", "shoot", "burning", "destroying", "hanging", "hurting", "shooting"))
GERUNDS = {
    "beheading": "behead", "burning": "burn", "destroying": "destroy", "hanging": "hang", "hurting": "hurt", "killing": "kill",
    "lynching": "lynch", "murdering": "murder", "raping": "rape", "shooting": "shoot", "stabbing": "stab",
}
PARTICIPLES = {
    "beheaded": "behead", "burned": "burn", "burnt": "burn", "destroyed": "destroy", "hanged": "hang", "hung": "hang",
    "killed": "kill", "lynched": "lynch", "murdered": "murder", "raped": "rape", "shot": "shoot", "stabbed": "stab",
}
#: Insults of several words, read as one.
PHRASES = dict.fromkeys((
    ("piece", "of", "shit"), ("pieces", "of", "shit"), ("waste", "of", "space"), ("waste", "of", "oxygen"), ("son", "of", "a", "bitch"),
    ("sons", "of", "bitches"), ("scum", "of", "the", "earth"), ("sack", "of", "shit"),
), 3.0)
MODALS = frozenset((
    "will", "shall", "should", "must", "gonna", "gotta", "going", "wanna", "want", "wants", "deserve", "deserves", "need", "needs", "let's",
    "lets", "i'll", "we'll", "you'll", "they'll", "he'll", "she'll", "i'd", "go", "please", "werde", "werden", "sollte", "sollten",
))
BEING = frozenset(("am", "are", "is", "was", "were", "be", "r", "bist", "ist", "sind", "seid", "es", "est", "eres", "son", "sont"))
#: Targets that are spoken to, and those that hold their own verb.
YOU = frozenset(("you", "u", "du", "ihr", "dich", "tu", "toi", "vous", "usted", "ustedes", "yourself", "yourselves"))
CONTRACTED = frozenset(("youre", "you're", "he's", "she's", "they're"))
TARGETS = YOU | CONTRACTED | frozenset((
    "you", "your", "yours", "youre", "you're", "he", "she", "they", "them", "him", "her", "u", "ur", "people",
    "everyone", "du", "ihr", "dich", "tu", "toi", "vous", "usted", "ustedes",
))
NEGATIONS = frozenset((
    "not", "no", "never", "isnt", "isn't", "arent", "aren't", "dont", "don't", "wasnt", "wasn't", "without", "neither",
    "nor", "nicht", "kein", "keine", "pas", "jamais", "nunca", "ni",
))
REPORTS = frozenset((
    "said", "says", "say", "wrote", "writes", "called", "calls", "claimed", "claims", "alleged", "quoted", "quote",
    "reported", "reportedly", "according", "sagte", "schrieb", "dit", "dijo",
))

#: Labelled documents of each label that the stems are learned from, at most.
SAMPLE = 4_000
#: Stems that are looked at more closely, and shortest and longest stem in letters.
CANDIDATES, SHORTEST, LONGEST = 2_000, 4, 6
PRECISION = 0.95
NEGATED, REPORTED, AIMED = 0.5, 0.6, 1.25
BIAS = 2.0
#: Words up to this weight say little alone: without a match those of a clause weigh that much together at most.
WEAK = 2.0
#: Labelled texts from which the weight of a fixed word is fitted.
SEEN = 5
#: Least weight of an insult or a threat whose clause is complete: it alone passes a score of 0.7.
MATCHED, DIRECTED = 3.5, 4.0
#: Classes of words that have a weight.
HEADS = ("insult", "slur", "threat", "harm", "harmed")
#: All classes; "" is any other word.
CLASSES = (*HEADS, "you", "contracted", "target", "negation", "report", "modal", "is", "like", "")

_WORD = re.compile(r"\w+(?:'\w+)?")
_CLAUSE_END = re.compile(r"[.!?;:\n]")
_PHRASES = {p[0]: [q for q in PHRASES if q[0] == p[0]] for p in PHRASES}


@dataclass(frozen=True)
class Transducer:
    """Reads a class of words at a time: (state, class) gives (state, factor), and a class that is
    not listed keeps to ``rest``. ``factor`` is what the weight of that word is multiplied with."""

    moves: dict[tuple[int, str], tuple[int, float]]
    rest: dict[int, tuple[int, float]] = field(default_factory=dict)

    def run(self, classes: Sequence[str]) -> list[float]:
        state, factors = 0, []
        for name in classes:
            state, factor = self.moves.get((state, name)) or self.rest.get(state, (state, 1.0))
            factors.append(factor)
        return factors


@dataclass(frozen=True)
class Matcher:
    """A transducer that emits a match when a clause completes: (state, class) gives (state, emits),
    a class that is not listed moves by ``rest``. The match belongs to the last word with a weight."""

    moves: dict[tuple[str, str], tuple[str, bool]]
    rest: dict[str, str]

    def run(self, classes: Sequence[str]) -> set[int]:
        """Places of the words whose clause completes."""
        state, head, out = "start", -1, set()
        for n, name in enumerate(classes):
            if name in HEADS:
                head = n
            state, emits = self.moves.get((state, name)) or (self.rest.get(state, "in"), False)
            if emits:
                out.add(head)
        return out


def _insults() -> Matcher:
    """``you [word] insult``; a target, a form of *to be*, up to three words, insult; ``insult like target``."""
    moves: dict[tuple[str, str], tuple[str, bool]] = {}
    rest = {"you2": "you1", "you1": "in", "one": "in", "is4": "is3", "is3": "is2", "is2": "is1", "is1": "in", "head": "in", "like": "in"}
    for state in ("start", "in", *rest):
        moves |= {(state, "you"): ("you2", False), (state, "target"): ("one", False), (state, "contracted"): ("is4", False)}
        moves |= {(state, name): ("head", False) for name in ("insult", "slur")}
    for state in ("you2", "you1", "one"):
        moves[state, "is"] = ("is4", False)
    for name in ("insult", "slur"):
        moves |= {(state, name): ("you2", True) for state in ("you2", "you1")}
        moves |= {(state, name): ("is4", True) for state in ("is4", "is3", "is2", "is1")}
    moves["head", "like"] = ("like", False)
    for name in ("you", "target"):
        moves["like", name] = ("in", True)
    return Matcher(moves, rest)


def _threats() -> Matcher:
    """A threat and, up to three words on, ``you``, or any target if the clause starts with the threat
    or a modal stands up to four words before; a target, a modal and a participle.

    Harms, which have other senses, always need the modal.
    """
    moves: dict[tuple[str, str], tuple[str, bool]] = {}
    rest = {"start": "in", "one2": "one1", "one1": "in"}
    for name, most in (("may", 4), ("one-may", 4), ("at-you", 3), ("at-any", 3)):
        rest |= {f"{name}{k}": f"{name}{k - 1}" if k > 1 else "in" for k in range(1, most + 1)}
    for state in ("in", *rest):
        may, one = "may" in state, state.startswith("one")
        moves[state, "modal"] = ("one-may4" if one else "may4", False)
        moves[state, "threat"] = ("at-any3" if may or state == "start" else "at-you3", False)
        moves[state, "harm"] = ("at-any3" if may else "in", False)
        moves[state, "harmed"] = ("in", may and one)
        for name in ("you", "target", "contracted"):
            reached = state.startswith("at-any") or name == "you" and state.startswith("at-you")
            moves[state, name] = (rest[state] if may else "one2", reached)
    return Matcher(moves, rest)


def _negation() -> Transducer:
    """An insult or threat up to two words behind a negation."""
    moves, rest = {}, {0: (0, 1.0), 1: (2, 1.0), 2: (0, 1.0)}
    for state in (0, 1, 2):
        moves[state, "negation"] = (1, 1.0)
        for name in HEADS:
            moves[state, name] = (0, 1.0 if state == 0 else NEGATED)
    return Transducer(moves, rest)


def _report() -> Transducer:
    """All that stands behind a verb of speech in the clause."""
    moves = {(s, "report"): (1, 1.0) for s in (0, 1)}
    moves |= {(1, name): (1, REPORTED) for name in HEADS}
    return Transducer(moves, {0: (0, 1.0), 1: (1, 1.0)})


def _target() -> Transducer:
    """An insult or a threat up to four words behind a target."""
    moves, rest = {}, {s: (max(0, s - 1), 1.0) for s in range(5)}
    for state in range(5):
        for name in ("target", "you", "contracted"):
            moves[state, name] = (4, 1.0)
        for name in ("insult", "slur"):
            moves[state, name] = (max(0, state - 1), AIMED if state else 1.0)
        for name in ("threat", "harm"):
            moves[state, name] = (max(0, state - 1), 2.0 if state else 1.0)
    return Transducer(moves, rest)


def _bare() -> Matcher:
    """A predicate without a target: an insult that the labels mark, wherever it stands."""
    return Matcher({(state, "slur"): ("in", True) for state in ("start", "in")}, {})


#: Machines that soften, and those that aim.
SOFTER, AIMING = (_negation(), _report()), (_target(),)
#: Name of a pattern, its machine, and the least weight of a match; None: a share of the word's own weight.
MATCHERS = (("insult", _insults(), MATCHED), ("threat", _threats(), DIRECTED), ("bare", _bare(), None))


@dataclass(frozen=True)
class Composed:
    """One machine whose states are tuples of those of all machines: (state, class) gives the next state,
    the factors that soften and aim, and the patterns that complete."""

    moves: dict[tuple[int, str], tuple[int, float, float, tuple[int, ...]]]

    def run(self, classes: Sequence[str]) -> list[tuple[float, float, set[int]]]:
        """For each word the factors, and the patterns whose match belongs to it: the last one with a weight."""
        state, head, out = 0, -1, []
        for n, name in enumerate(classes):
            if name in HEADS:
                head = n
            state, softer, aimed, complete = self.moves[state, name]
            out.append((softer, aimed, set()))
            if complete:
                out[head][2].update(complete)
        return out


def compose(
    softer: Sequence[Transducer] = SOFTER,
    aiming: Sequence[Transducer] = AIMING,
    matchers: Sequence[Matcher] = tuple(m for _, m, _ in MATCHERS),
) -> Composed:
    """The product of the machines: all tuples of states that can be reached from the first."""
    def step(machine: Transducer, state: int, name: str) -> tuple[int, float]:
        return machine.moves.get((state, name)) or machine.rest.get(state, (state, 1.0))

    first = ((0,) * len(softer), (0,) * len(aiming), ("start",) * len(matchers))
    numbers, todo, moves = {first: 0}, [first], {}
    while todo:
        states = todo.pop()
        for name in CLASSES:
            soft = [step(m, s, name) for m, s in zip(softer, states[0], strict=True)]
            aim = [step(m, s, name) for m, s in zip(aiming, states[1], strict=True)]
            match = [
                m.moves.get((s, name)) or (m.rest.get(s, "in"), False)
                for m, s in zip(matchers, states[2], strict=True)
            ]
            after = tuple(tuple(s for s, _ in part) for part in (soft, aim, match))
            if after not in numbers:
                numbers[after] = len(numbers)
                todo.append(after)
            moves[numbers[states], name] = (
                numbers[after], math.prod(f for _, f in soft), math.prod(f for _, f in aim),
                tuple(n for n, (_, emits) in enumerate(match) if emits),
            )
    return Composed(moves)


MACHINE = compose()


@dataclass(frozen=True)
class Lexicon:
    """Weights of whole words and of stems, with which words start. ``bare``: how much of the weight of an
    insult counts where it has no target."""

    words: dict[str, float]
    stems: dict[str, float]
    threats: dict[str, float] = field(default_factory=lambda: dict(THREATS))
    bare: float = 1.0

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for word in {**self.words, **self.stems, **THREATS, **GERUNDS, **PARTICIPLES, **{p[0]: 0 for p in PHRASES}}:
            found.add_word(word, len(word))
        if len(found):
            found.make_automaton()
        return found

    def weight(self, word: str) -> float:
        known = self.words.get(word)
        if known is None and word.endswith("s"):
            known = self.words.get(word[:-1])
        if known is not None:
            return known
        for length in range(min(len(word), LONGEST), SHORTEST - 1, -1):
            if word[:length] in self.stems:
                return self.stems[word[:length]]
        return 0.0

    def classify(self, word: str) -> tuple[str, float]:
        weight = self.weight(word)
        if weight:
            return "slur" if weight > WEAK else "insult", weight
        verb = word if word in THREATS else GERUNDS.get(word) or PARTICIPLES.get(word)
        if verb:
            return "harmed" if word in PARTICIPLES else "harm" if word in HARMS else "threat", self.threats[verb]
        for name, members in (
            ("you", YOU), ("contracted", CONTRACTED), ("target", TARGETS), ("negation", NEGATIONS), ("report", REPORTS),
            ("modal", MODALS), ("is", BEING),
        ):
            if word in members:
                return name, 0.0
        return ("like" if word == "like" else ""), 0.0

    def read(self, clause: str) -> list[tuple[str, float]]:
        """Class and weight of each word; a phrase is one word."""
        words, out, at = _WORD.findall(clause), [], 0
        while at < len(words):
            phrase = next((p for p in _PHRASES.get(words[at], ()) if tuple(words[at : at + len(p)]) == p), None)
            out.append(("slur", PHRASES[phrase]) if phrase else self.classify(words[at]))
            at += len(phrase or "1")
        return out

    def judge(self, clause: str) -> tuple[float, str, float]:
        """Weight of a clause, and pattern and weight of its strongest match, empty and 0 without one.

        Matched words have their weights under the grammar, at a target at least that of the match, and less
        if negated or reported. The others weigh :data:`WEAK` together at most.
        """
        read = self.read(clause)
        weak = strong = best = 0.0
        pattern = ""
        for (_, w), (softer, aimed, matches) in zip(read, MACHINE.run([name for name, _ in read]), strict=True):
            if not matches:
                weak += w * aimed * softer
                continue
            least, name = max((MATCHERS[n][2] or 0.0, MATCHERS[n][0]) for n in matches)
            value = softer * (max(w * aimed, least) if least else w * aimed * self.bare)
            strong += value
            if value > best:
                best, pattern = value, name
        return strong + min(weak, WEAK), pattern, best

    def weigh(self, clause: str) -> float:
        return self.judge(clause)[0]

    def clauses(self, text: str) -> list[tuple[str, float]]:
        return [(clause, weight) for clause, weight, *_ in self.judged(text)]

    def judged(self, text: str) -> list[tuple[str, float, str, float]]:
        """The clauses that hold an insult or a threat, and how each is judged. Others are not read."""
        text, out, done = text.lower().replace("\u2019", "'"), [], -1
        if not len(self.automaton):
            return out
        for end, length in self.automaton.iter(text):
            begin = end + 1 - length
            if begin < done or (begin and (text[begin - 1].isalnum() or text[begin - 1] == "_")):
                continue
            start = done if done >= 0 else 0
            for mark in _CLAUSE_END.finditer(text, max(start, 0), begin):
                start = mark.end()
            closing = _CLAUSE_END.search(text, end + 1)
            done = closing.start() if closing else len(text)
            clause = text[start:done]
            judgement = self.judge(clause)
            if judgement[0]:
                out.append((clause, *judgement))
        return out

    def score(self, text: str | None) -> tuple[float, int, str]:
        """By the strongest clause, so that a text is not toxic for being long; how many clauses weigh
        something; and the pattern that the strongest matches, empty if none."""
        found = self.judged(text or "")
        _, total, pattern, _ = max(found, key=lambda f: f[1], default=("", 0.0, "", 0.0))
        return 1.0 / (1.0 + math.exp(BIAS - min(total, 50.0))), len(found), pattern


def stems_of(text: str) -> set[str]:
    """The different words of a text, each followed by a blank, and their stems."""
    words = set(_WORD.findall(text.lower()))
    stems = {w[:n] for w in words for n in range(SHORTEST, min(LONGEST, len(w)) + 1)}
    return stems | {w + " " for w in words}


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[batch.column(i).to_pylist() for i in range(batch.num_columns)], strict=True)


def learn(labelled: DataFrame, sample: int = SAMPLE) -> Lexicon:
    """Words and stems that mark toxic texts. ``labelled``: text, label (1: toxic, 0: clean).

    From at most ``sample`` texts of each label (those with the smallest hashes; equal texts count
    once). A stem is taken if hardly any clean text has it and it stands in 2% of the toxic ones, or
    if it explains toxic texts that those taken before leave unexplained. Words of the fixed list
    and threats have the weight that the labels give them if at least ``SEEN`` labelled texts have them.
    Insults without a target count by the share that the labels give them: the log-odds of texts that such a
    clause decides, over the mean weight of its strongest word, 1 at most; it is fitted on the texts that the words are
    learned from. Of the stems the ``CANDIDATES`` that most toxic texts have are looked at.
    Without toxic or without clean
    texts the fixed list is all there is. NULL and empty texts and other labels are left out.
    """
    prepare_python(labelled.sparkSession)
    given = labelled.filter("text IS NOT NULL AND text <> '' AND label IN (0, 1)").select(
        "text", "label", F.xxhash64("text").alias("hash")
    )
    parts = [
        given.filter(F.col("label") == label).groupBy("hash").agg(F.min("text").alias("text"))
        .orderBy("hash").limit(sample).select("text", F.lit(label).alias("label"))
        for label in (0, 1)
    ]
    texts = keep(parts[0].unionByName(parts[1]))

    def count(batches):
        toxic, clean = Counter(), Counter()
        for text, label in _texts(batches):
            (toxic if label else clean).update(stems_of(text))
        stems = list(toxic)
        clean_only = [s for s in clean if s not in toxic]
        yield pa.RecordBatch.from_arrays(
            [pa.array(stems + clean_only, pa.string()), pa.array([toxic[s] for s in stems] + [0] * len(clean_only), pa.int64()),
             pa.array([clean[s] for s in stems] + [clean[s] for s in clean_only], pa.int64())], names=["stem", "toxic", "clean"]
        )

    sizes = dict(texts.groupBy("label").count().collect())
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return Lexicon(dict(INSULTS), {})
    counts = (
        texts.mapInArrow(count, "stem string, toxic bigint, clean bigint").groupBy("stem")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )
    rate = (F.col("toxic") / n_toxic) / (F.col("toxic") / n_toxic + F.col("clean") / n_clean)
    candidates = {
        r["stem"]: (r["toxic"], r["clean"]) for r in
        counts.filter((F.col("toxic") >= 2) & (rate >= PRECISION))
        .orderBy(F.desc("toxic"), "clean", F.length("stem"), "stem").limit(CANDIDATES).collect()
    }
    # The most telling form: a stem that hardly says more than a longer one gives way to that one.
    candidates = {
        s: seen for s, seen in candidates.items()
        if not any(c != s and c.startswith(s) and candidates[c][0] >= 0.8 * seen[0] for c in candidates)
    }
    known = {
        r["stem"].strip(): (r["toxic"], r["clean"])
        for r in counts.filter(F.col("stem").isin([w + " " for w in (*INSULTS, *THREATS)])).collect()
    }

    def held(batches):
        for text, label in _texts(batches):
            if label:
                some = sorted(stems_of(text) & candidates.keys())
                yield pa.RecordBatch.from_arrays([pa.array([some], pa.list_(pa.string()))], names=["stems"])

    having = [set(r["stems"]) for r in texts.filter("label = 1").mapInArrow(held, "stems array<string>").collect()]
    strong = max(8, 0.02 * n_toxic)
    chosen: list[str] = []
    left = having
    order = sorted(candidates, key=lambda s: (-candidates[s][0], candidates[s][1], len(s), s))
    for stem in order:
        if candidates[stem][0] >= strong and not any(stem.startswith(c) for c in chosen):
            chosen.append(stem)
    left = [h for h in left if not h & set(chosen)]
    while left:
        gains = Counter(s for h in left for s in h)
        stem = min(gains, key=lambda s: (-gains[s], candidates[s][1], len(s), s), default=None)
        if stem is None or gains[stem] < 2:
            break
        chosen.append(stem)
        left = [h for h in left if stem not in h]

    def odds(toxic: int, clean: int) -> float:
        return math.log((toxic + 0.5) / (n_toxic + 1)) - math.log((clean + 0.5) / (n_clean + 1))

    def fitted(fixed: dict[str, float], least: float) -> dict[str, float]:
        return {w: min(6.0, max(least, odds(*known[w]))) if sum(known.get(w, (0, 0))) >= SEEN else weight for w, weight in fixed.items()}

    words = fitted(INSULTS, 0.5)
    words |= {s.strip(): min(6.0, max(0.5, odds(*candidates[s]))) for s in chosen if s.endswith(" ")}
    stems = {s: min(6.0, max(0.5, odds(*candidates[s]))) for s in chosen if not s.endswith(" ")}
    lexicon = Lexicon(words, stems, fitted(THREATS, 0.25))

    def decided(batches):
        for text, label in _texts(batches):
            _, _, pattern, weight = max(lexicon.judged(text), key=lambda f: f[1], default=("", 0.0, "", 0.0))
            if pattern == "bare":
                yield pa.RecordBatch.from_arrays(
                    [pa.array([label], pa.int64()), pa.array([weight], pa.float64())], names=["label", "weight"]
                )

    bare = {
        r["label"]: (r["texts"], r["weight"]) for r in texts.mapInArrow(decided, "label bigint, weight double")
        .groupBy("label").agg(F.count("*").alias("texts"), F.sum("weight").alias("weight")).collect()
    }
    toxic, clean = bare.get(1, (0, 0.0)), bare.get(0, (0, 0.0))
    if toxic[0] + clean[0] < SEEN:
        return lexicon
    mean = (toxic[1] + clean[1]) / (toxic[0] + clean[0])
    return replace(lexicon, bare=min(1.0, max(0.0, odds(toxic[0], clean[0]) / mean)))


def score(df: DataFrame, lexicon: Lexicon, text: str = "text", name: str = "toxicity") -> DataFrame:
    """All rows and columns, and the struct ``name``: score (0 to 1), clauses (how many weigh something) and
    pattern (which one the strongest clause matches: insult, threat, bare, or empty). Without a match a score
    stays at 0.5 or below.

    Whole texts are read. A NULL or empty text has the score of a text without any match. A column
    of the name is replaced. Rows are independent: repeated ones get the same score, and an empty
    table gives an empty table.
    """
    prepare_python(df.sparkSession)
    kind = pa.struct([("score", pa.float64()), ("clauses", pa.int64()), ("pattern", pa.string())])

    @F.arrow_udf("score double, clauses bigint, pattern string")
    def scored(texts: pa.Array) -> pa.Array:
        found = [lexicon.score(t.as_py()) for t in texts]
        return pa.array([{"score": s, "clauses": n, "pattern": p} for s, n, p in found], kind)

    rest = [F.col(f"`{c}`") for c in df.columns if c.lower() != name.lower()]
    return df.select(*rest, scored(F.col(f"`{text}`").cast("string")).alias(name))


def held_out(identity: Column) -> Column:
    """Rows whose labels are never learned from: CRC-32 of the id as text, 1 modulo 3."""
    return F.crc32(F.coalesce(identity.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def learn_from_tables(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Lexicon:
    """:func:`learn` from documents (doc_id, text) and labels (doc_id, toxic).

    At most ``sample`` labels of each kind are drawn first, so that what is joined is bounded and
    the texts are not shuffled.
    """
    usable = labels.filter(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()).select(
        "doc_id", F.col("toxic").alias("label")
    )
    drawn = [
        usable.filter(F.col("label") == label).distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        for label in (0, 1)
    ]
    few = F.broadcast(keep(drawn[0].unionByName(drawn[1])))
    return learn(documents.select("doc_id", "text").join(few, "doc_id"), sample)

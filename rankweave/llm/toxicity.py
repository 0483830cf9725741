"""Toxicity: a weighted grammar of five composed transducers scores clauses that match an insult or a threat.

A clause ends at a full stop, a question or exclamation mark, a semicolon, a line feed or the end of the text. Its words
fall into classes. Transducers for insult, threat, target, negation and reported speech read the classes in step, and
their composition says at the end of the clause which patterns it matches. There the clause speaks one weight, that of
its path: the sum over the insult and threat words that the matched patterns took. Patterns:

- insult: a word of that class, bare, aimed (a target at most SCOPE words away on either side), called (a copula at most
  SCOPE words before it), or both;
- threat: a word of that class, aimed or intended (will, going, ... at most SCOPE words before it), or both; a threat
  word with neither matches nothing, so to kill time is no threat.

A matched clause is negated where a negation stands at most SCOPE words before every insult and threat word of it, and
reported where a verb of speech stands anywhere in it. The classes grow from labelled texts (words, and beginnings of
words of 3 to 8 letters that stand for their endings), and the weight of each pattern is fitted on other labelled texts.
"""

from __future__ import annotations

import re
from collections.abc import Hashable, Iterable
from typing import Callable, NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Labelled rows the model is fitted on at most; which ones follows from a hash of doc_id.
LABEL_ROWS = 20_000
# Letters of a beginning of a word that may become an entry of its own; whole words of any length may, too.
STEMS = range(3, 9)
LEAST_SEEN = 8
LEAST_RATE = 0.9
LEAST_SHARE = 0.5
# Words between the parts of a pattern.
SCOPE = 4

# Common words of each class in English, German, French and Spanish.
INSULTS = "idiot moron scum trash loser stupid pathetic worthless disgusting dumm dummkopf trottel abschaum widerlich connard imbécile crétin stupide idiota imbécil estúpido basura".split()
THREATS = "kill hurt destroy punish töten umbringen vernichten tuer détruire frapper matar destruir golpear".split()
TARGETS = "you your yours them they him she du ihr dich euch sie tu vous toi vos ils elles tú usted ustedes ellos".split()
COPULAS = "is are was were am be being been bist ist sind seid war waren es est sont êtes était eres son era eran sois".split()
INTENTS = "will shall going gonna must werde werden wirst muss vais va vont allons voy vas vamos van".split()
NEGATIONS = "not no never none cannot nicht kein keine nie pas jamais aucun ne nunca ningún ni".split()
REPORTS = "said says quoted claimed wrote reported sagte schrieb behauptete dit écrit affirme dijo escribió afirma".split()

OTHER, INSULT, THREAT, TARGET, COPULA, INTENT, NEGATION, REPORT, END = range(9)
TOKENS = re.compile(r"[^\W\d_]+|[.!?;\n]")
MARKS = {".", "!", "?", ";", "\n"}


class Transducer(NamedTuple):
    """A machine over word classes: where it starts, where a class takes it, and what a state says when a clause ends there."""

    start: Hashable
    step: Callable[[Hashable, int], Hashable]
    says: Callable[[Hashable], tuple]


def _called(hit: int, before: int) -> Transducer:
    """Says 0 without a word of class `hit`, 2 where one has a word of class `before` at most SCOPE words before it, else 1."""

    def step(state, symbol):
        left, level = state
        if symbol == hit:
            level = max(level, 2 if left else 1)
        return SCOPE if symbol == before else max(0, left - 1), level

    return Transducer((0, 0), step, lambda state: (state[1],))


def _aimed(hit: int) -> Transducer:
    """Says whether a target stands at most SCOPE words before or after a word of class `hit`."""

    def step(state, symbol):
        target, struck, met = state
        met = met or (symbol == hit and target > 0) or (symbol == TARGET and struck > 0)
        return SCOPE if symbol == TARGET else max(0, target - 1), SCOPE if symbol == hit else max(0, struck - 1), met

    return Transducer((0, 0, False), step, lambda state: (state[2],))


def _negated() -> Transducer:
    """Says whether there are insult or threat words and each has a negation at most SCOPE words before it."""

    def step(state, symbol):
        left, hits = state  # hits: 0 none, 1 all negated, 2 some not
        if symbol in (INSULT, THREAT):
            hits = max(hits, 1 if left else 2)
        return SCOPE if symbol == NEGATION else max(0, left - 1), hits

    return Transducer((0, 0), step, lambda state: (state[1] == 1,))


def _reported() -> Transducer:
    return Transducer(False, lambda state, symbol: state or symbol == REPORT, lambda state: (state,))


def compose(first: Transducer, second: Transducer) -> Transducer:
    """Both at once: a state is a pair of states, and a pair says what both say."""
    return Transducer(
        (first.start, second.start),
        lambda state, symbol: (first.step(state[0], symbol), second.step(state[1], symbol)),
        lambda state: first.says(state[0]) + second.says(state[1]),
    )


# Says: insult level, insult aimed, threat level, threat aimed, negated, reported.
_INSULT = compose(_called(INSULT, COPULA), _aimed(INSULT))
_THREAT = compose(_called(THREAT, INTENT), _aimed(THREAT))
GRAMMAR = compose(compose(compose(_INSULT, _THREAT), _negated()), _reported())
PATTERNS = ["insult", "insult aimed", "insult called", "insult aimed and called", "threat aimed or intended", "threat aimed and intended", "negated", "reported"]


def patterns(said: tuple) -> list[int]:
    """Numbers of the patterns that a clause matches; none where it has neither an insult nor a threat."""
    insult, insult_aimed, threat, threat_aimed, negated, reported = said
    out = []
    if insult:
        out.append(2 * (insult == 2) + insult_aimed)
    if threat == 2 or threat and threat_aimed:
        out.append(4 + (threat == 2 and threat_aimed))
    if out:
        out += [6] * negated + [7] * reported
    return out


class Lazy:
    """A transducer whose states are numbered when they are first met; most states of a composition never are."""

    def __init__(self, machine: Transducer):
        self.machine, self.number, self.states = machine, {machine.start: 0}, [machine.start]
        self.steps: list[list[int | None]] = [[None] * END]
        self.ends: list[list[int] | None] = [None]

    def step(self, state: int, symbol: int) -> int:
        to = self.steps[state][symbol]
        if to is None:
            reached = self.machine.step(self.states[state], symbol)
            to = self.number.setdefault(reached, len(self.states))
            if to == len(self.states):
                self.states.append(reached)
                self.steps.append([None] * END)
                self.ends.append(None)
            self.steps[state][symbol] = to
        return to

    def end(self, state: int) -> list[int]:
        if self.ends[state] is None:
            self.ends[state] = patterns(self.machine.says(self.states[state]))
        return self.ends[state]


_machine = Lazy(GRAMMAR)


class Lexicon(NamedTuple):
    """Classes and weights of words, and weights of beginnings of words, which are insults."""

    words: dict[str, tuple[int, float]]
    stems: dict[str, float]


def seed_words() -> dict[str, tuple[int, float]]:
    words = {x: (END, 0.0) for x in MARKS}
    classes = ((TARGET, TARGETS), (COPULA, COPULAS), (INTENT, INTENTS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (THREAT, THREATS), (INSULT, INSULTS))
    for symbol, some in classes:
        words |= {x: (symbol, 1.0) for x in some}
    return words


def clause_sums(texts: Iterable[str | None], lexicon: Lexicon) -> np.ndarray:
    """For each text and pattern the weights of the clauses that match it, added up."""
    out, known, stems = [], lexicon.words, lexicon.stems
    starts = {x[: STEMS[0]] for x in stems}
    step, end = _machine.step, _machine.end
    zero = np.zeros(len(PATTERNS))

    def entry_of(token: str) -> tuple[int, float] | None:
        found = known.get(token)
        if found is None:
            stem = next((token[:k] for k in STEMS if token[:k] in stems), None)
            found = None if stem is None else (INSULT, stems[stem])
        return found

    for text in texts:
        tokens = TOKENS.findall((text or "").lower())
        heard = [(i, entry_of(t)) for i, t in enumerate(tokens) if t in known or t[: STEMS[0]] in starts]
        if not any(e and e[0] in (INSULT, THREAT) for _, e in heard):
            out.append(zero)
            continue
        sums, state, last, weight = zero.copy(), 0, -1, {INSULT: 0.0, THREAT: 0.0}
        for i, entry in [*heard, (len(tokens), (END, 0.0))]:
            if entry is None:
                continue
            if entry[0] == END:
                matched = end(state)
                if matched:
                    spoken = weight[INSULT] + (weight[THREAT] if any(PATTERNS[k].startswith("threat") for k in matched) else 0)
                    sums[matched] += spoken
                state, last, weight = 0, i, {INSULT: 0.0, THREAT: 0.0}
                continue
            for _ in range(min(i - last - 1, SCOPE)):  # words outside the lexicon; more of them change nothing
                state = step(state, OTHER)
            if entry[0] in (INSULT, THREAT):
                weight[entry[0]] += entry[1]
            state, last = step(state, entry[0]), i
        out.append(sums)
    return np.array(out).reshape(-1, len(PATTERNS))


def features(sums: np.ndarray) -> np.ndarray:
    """What is weighted: damped sums of the patterns, of all insults and threats, whether any clause matches, and one."""
    whole = sums[:, :6].sum(1, keepdims=True)
    return np.hstack([np.log1p(sums), np.log1p(whole), whole > 0, np.ones((len(sums), 1))])


def _fitted(x: np.ndarray, y: np.ndarray, ridge: float = 0.02, rounds: int = 40) -> np.ndarray:
    """Logistic weights by Newton steps with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) / len(y) + ridge / 10 * w
        bend = (x * (p * (1 - p))[:, None]).T @ x / len(y) + ridge / 10 * np.eye(len(w))
        w -= np.linalg.solve(bend, slope)
    return w


def held_out(id_column: str = "doc_id") -> Column:
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % 5 == 0


def labelled_texts(docs: DataFrame, labels: DataFrame, rows: int = LABEL_ROWS) -> DataFrame:
    """text, toxic, half: at most `rows` labelled texts outside the held-out fold, near copies thinned out.

    One text is taken for each smallest hash among its long words, so a group of copies counts about once.
    """
    own = labels.where("doc_id is not null and toxic is not null").where(~held_out()).select("doc_id", "toxic")
    own = own.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    own = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(own), "doc_id")
    long = F.array_min(F.transform(F.expr(r"regexp_extract_all(lower(text), '\\p{L}{9,}', 0)"), lambda x: F.xxhash64(x)))
    texts = texts.withColumn("like", F.coalesce(long, F.xxhash64("text")))
    one = texts.groupBy("like", "toxic").agg(F.min_by("text", F.struct("doc_id", "text")).alias("text"))
    return one.select("text", "toxic", F.pmod("like", F.lit(2)).alias("half"))


def learn_lexicon(texts: DataFrame) -> Lexicon:
    """Seeds, and words and beginnings of words that labelled texts show to be toxic. `texts` has text, toxic.

    An entry is taken when it is seen in LEAST_SEEN toxic texts, its rate in toxic texts is LEAST_RATE of both rates
    together, and toxic texts are LEAST_SHARE of all that have it; its weight is the logarithm of the ratio. Longer
    beginnings of one that is taken are left out. Learned words are insults unless they are seeds of the threats. The
    labelled rows bound how many entries there are.
    """
    rows = {int(r["toxic"]): r["n"] for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = rows.get(1, 0), rows.get(0, 0)
    seeds = seed_words()
    if not toxic or not clean:
        return Lexicon(seeds, {})
    words = texts.select("toxic", F.explode(F.array_distinct(F.expr(r"regexp_extract_all(lower(text), '\\p{L}+', 0)"))).alias("word"))
    words = words.groupBy("word").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    lengths = F.array(*[F.lit(k) for k in STEMS])
    entry = F.explode(F.concat(F.array(F.col("word")), F.transform(F.filter(lengths, lambda k: k <= F.length("word")), lambda k: F.concat(F.col("word").substr(F.lit(1), k), F.lit("*")))))
    entries = words.where(F.length("word") >= STEMS[0]).select(entry.alias("entry"), "bad", "good")
    entries = entries.groupBy("entry").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    bad, good = (F.col("bad") + 0.5) / toxic, (F.col("good") + 0.5) / clean
    entries = entries.withColumn("weight", F.log(bad / good))
    strong = entries.where((F.col("bad") >= LEAST_SEEN) & (bad / (bad + good) >= LEAST_RATE) & (F.col("bad") >= LEAST_SHARE * (F.col("bad") + F.col("good"))))
    strong = strong.select("entry", "weight").collect()
    stems: dict[str, float] = {}
    for r in sorted(strong, key=lambda r: (len(r["entry"]), r["entry"])):
        stem = r["entry"][:-1]
        if r["entry"].endswith("*") and not any(stem[:k] in stems for k in STEMS if k < len(stem)):
            stems[stem] = float(r["weight"])
    for r in strong:
        word = r["entry"]
        symbol = seeds.get(word, (INSULT,))[0]
        if not word.endswith("*") and symbol in (INSULT, THREAT):
            seeds[word] = (symbol, float(r["weight"]))
    return Lexicon(seeds, stems)


def _gathered(texts: DataFrame, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray]:
    """Sums over clauses and labels of a table of at most LABEL_ROWS texts."""

    @F.pandas_udf("array<double>")
    def told(text: pd.Series) -> pd.Series:
        return pd.Series(list(clause_sums(text, lexicon)))

    rows = texts.select("toxic", told("text").alias("sums")).toPandas()
    return np.array([list(x) for x in rows["sums"]]).reshape(-1, len(PATTERNS)), rows["toxic"].to_numpy(float)


class Model(NamedTuple):
    lexicon: Lexicon
    weights: np.ndarray

    def score(self, texts: Iterable[str | None]) -> np.ndarray:
        z = features(clause_sums(texts, self.lexicon)) @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, rows: int = LABEL_ROWS) -> Model:
    """Lexicon from one half of the labelled texts, weights of the patterns from the other."""
    from rankweave.llm.common import kept

    texts = kept(labelled_texts(docs, labels, rows), "labelled-texts")
    lexicon = learn_lexicon(texts.where("half = 0").select("text", "toxic"))
    sums, toxic = _gathered(texts.where("half = 1"), lexicon)
    if not len(toxic) or toxic.min() == toxic.max():  # nothing to fit on: the patterns count alike, more so where aimed, less where negated or reported
        return Model(lexicon, np.array([1, 2, 2, 3, 2, 3, -2, -1, 0, 1, -2.0]))
    return Model(lexicon, _fitted(features(sums), toxic))


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = LABEL_ROWS) -> DataFrame:
    """One row for each row of `docs`: doc_id, held_out, score, predicted.

    Only whole texts are scored; a null text scores as an empty one, which has no matched clause. A null doc_id is
    not held out and never learned from. Labels of a doc_id given twice count once, toxic if any says so. Without
    labels of both kinds the seeds alone decide.
    """
    model = fit(docs, labels, rows)

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series(model.score(text))

    scored = docs.select(F.col("doc_id"), F.coalesce(held_out(), F.lit(False)).alias("held_out"), score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))

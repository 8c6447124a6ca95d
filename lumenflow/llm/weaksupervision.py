"""Text quality by weak supervision: rules vote or abstain, EM weighs them.

Each rule looks at counts of a text and votes good, bad, or abstains. No rule
decides alone. The model has a good class and a bad one, and the bad class is
a mixture of kinds, one for each rule that votes bad, since bad texts of
different kinds trip different rules. Given the class (and kind), rules vote
independently, each with its own probabilities of the three votes.
Expectation-maximisation fits the shares and these probabilities, hence each rule's
accuracy, to the votes of all texts; the posterior probability of the good class
replaces the filter that wants every rule passed.

Texts with equal votes are alike to the model, so the corpus is counted by vote
pattern in one combining aggregate. There are 3 ** rules patterns at most,
whatever the corpus; that bound is what makes the counts and the posteriors small
enough for the driver. The fit starts from rules that seldom vote against the class
they name. Prior counts in proportion to the corpus hold it near that, and each
kind keeps its own rule's vote at MIN_OWN or more, so that classes keep their meaning,
a text without a bad vote is good, and a fit behaves alike at every size.

The counts come from numpy arrays of words and lines of a few MB of texts
at a time (textops). Repeats are found by 64-bit hashes of lines and of
windows of five words.

Defined results: a null or empty text has no words, all its rules abstain but
the fragment rule, which votes bad; with no rows there is nothing to fit and the starting
model stands; repeated rows are judged alike; other columns pass through, those named
like an output are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from lumenflow.llm import textops as t

WINDOW = 5
GOOD, BAD, ABSTAIN = 0, 1, 2
VOTES = "gb-"
ITERATIONS = 200
#: Prior votes per class and rule, as a share of all texts.
PRIOR_SHARE = 0.02
START_GOOD = 0.85
#: How often a rule votes at the start: bad on its own kind, on another kind, on good texts; vouching on good, on bad ones.
START_OWN, START_OTHER, START_WRONG, START_VOUCH, START_VOUCH_WRONG = 0.95, 0.2, 0.01, 0.8, 0.5
MIN_OWN = 0.95
MIN_POSTERIOR = 0.5

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_CONTINUATION = (np.arange(256) & 0xC0) == 0x80
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_SENTENCE_END = np.zeros(256, bool)
_SENTENCE_END[list(b".!?")] = True

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_MORE = ("n_lines", "n_upper", "n_letters", "n_bang", "n_ends", "n_distinct", "n_alpha_words")


def counts(column: pa.Array) -> dict[str, np.ndarray]:
    """The counts of each text, COUNTS and those that only rules use."""
    parts: list[dict[str, np.ndarray]] = [_slice_counts(column.slice(a, b - a)) for a, b in t.slices(column)]
    names = (*COUNTS, *_MORE)
    return {n: np.concatenate([p[n] for p in parts]) if parts else np.zeros(0, np.int64) for n in names}


def _repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether the key is equal to one before it, whether it occurs twice or more)."""
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    later, twice = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:]] = same
    twice[order[1:]] = same
    twice[order[:-1]] |= same
    return later, twice


def _slice_counts(column: pa.Array) -> dict[str, np.ndarray]:
    data, offsets = t.buffer(column)
    n = len(offsets) - 1
    starts, ends, first = t.words(data, offsets)
    hashes = t.span_hashes(data, starts, ends)
    out = {"n_words": np.diff(first)}
    word_row = np.repeat(np.arange(n), out["n_words"])
    characters = np.zeros(len(data) + 1, np.int64)
    np.cumsum(~_CONTINUATION[data], out=characters[1:])
    out["word_chars"] = t.per_row(characters[ends] - characters[starts], first)
    for name, table in (("n_symbols", _SYMBOL), ("n_upper", _UPPER), ("n_letters", _LETTER)):
        out[name] = t.per_row(table[data], offsets)

    begin, end, row = t.lines(data, offsets)
    line_words = np.searchsorted(starts, end) - np.searchsorted(starts, begin)
    full = line_words > 0
    salt = t.mix(np.arange(n, dtype=np.uint64) + np.uint64(1))
    later, _ = _repeated(t.span_hashes(data, begin[full], end[full]) ^ salt[row[full]])
    out["n_lines"] = np.bincount(row[full], minlength=n)
    out["n_dup_lines"] = np.bincount(row[full], weights=later, minlength=n).astype(np.int64)

    keys, at, window_row = t.windows(hashes, first, WINDOW)
    _, twice = _repeated(keys ^ salt[window_row])
    edge = np.zeros(len(starts) + 1, np.int64)
    np.add.at(edge, at[twice], 1)
    np.add.at(edge, at[twice] + WINDOW, -1)
    out["n_repeat_words"] = t.per_row(np.cumsum(edge)[:-1] > 0, first)

    later, _ = _repeated(hashes ^ salt[word_row])
    out["n_distinct"] = t.per_row(~later, first)
    tail = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    tail2 = data[np.maximum(ends - 2, 0)] if len(ends) else tail
    out["n_bang"] = t.per_row((tail == 33) & (tail2 == 33) & (ends - starts > 1), first)
    out["n_ends"] = t.per_row(_SENTENCE_END[tail], first)
    letters = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_LETTER[data] | (data >= 128), out=letters[1:])
    lettered = letters[ends] - letters[starts]
    out["n_alpha_words"] = t.per_row(lettered > 0, first)
    return out


def rule_votes(c: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Each rule's vote on each text: most vote bad or abstain, some vote good or abstain."""
    words = c["n_words"]
    some = np.maximum(words, 1)
    long = words >= 30

    def bad(value, when=words > 0):
        return np.where(when & value, BAD, ABSTAIN)

    ends = c["n_ends"] / some
    return {
        "fragment": bad(words < 3, words >= 0),
        "symbols": bad(c["n_symbols"] / some > 0.1),
        "letters": bad(c["n_alpha_words"] / some < 0.7, words >= 20),
        "shouting": bad(c["n_bang"] / some > 0.15),
        "capitals": bad(c["n_upper"] / np.maximum(c["n_letters"], 1) > 0.4, c["n_letters"] >= 20),
        "repeats": bad(c["n_repeat_words"] / some > 0.2),
        "lines": bad(c["n_dup_lines"] / np.maximum(c["n_lines"], 1) > 0.4, c["n_lines"] >= 4),
        "variety": bad(c["n_distinct"] / np.sqrt(some) < 1.5, long),
        "no_sentences": bad((ends < 0.004) | (ends > 0.6), long),
        "sentences": np.where(long & (ends > 0.03) & (ends < 0.5), GOOD, ABSTAIN),
    }


RULES = ("fragment", "symbols", "letters", "shouting", "capitals", "repeats", "lines", "variety", "no_sentences", "sentences")
#: Rules that vote good or abstain; the others vote bad or abstain.
VOUCHING = frozenset({"sentences"})


def with_votes(df: DataFrame, text: str = "text", votes: str = "votes", prefix: str = "") -> DataFrame:
    """``df`` with the counts of the whole text (names after ``prefix``) and ``votes``, a letter per rule (g, b or -)."""

    def compute(column: pa.Array) -> list[pa.Array]:
        c = counts(column)
        by_rule = rule_votes(c)
        letters = np.frombuffer(VOTES.encode(), np.uint8)
        table = np.stack([letters[by_rule[r]] for r in RULES], axis=1) if len(column) else np.zeros((0, len(RULES)), np.uint8)
        patterns = [row.tobytes().decode() for row in table]
        return [*[pa.array(c[n].astype(np.int64)) for n in COUNTS], pa.array(patterns, pa.string())]

    return t.add_columns(df, [text], [*[(prefix + n, LongType()) for n in COUNTS], (votes, StringType())], compute)


class Model:
    """Shares of the good class and the bad kinds, and theta[rule, class, vote]."""

    def __init__(self) -> None:
        tiny = 1e-4  # of the vote that a rule doesn't give
        self.kinds = [r for r, name in enumerate(RULES) if name not in VOUCHING]
        self.share = np.array([START_GOOD, *[(1 - START_GOOD) / len(self.kinds)] * len(self.kinds)])
        self.theta = np.zeros((len(RULES), len(self.share), 3))
        for r, name in enumerate(RULES):
            vouches = name in VOUCHING
            own, other = (GOOD, BAD) if vouches else (BAD, GOOD)
            often = np.full(len(self.share), START_VOUCH_WRONG if vouches else START_OTHER)
            often[0] = START_VOUCH if vouches else START_WRONG
            if not vouches:
                often[1 + self.kinds.index(r)] = START_OWN
            self.theta[r, :, own], self.theta[r, :, other] = often, tiny
            self.theta[r, :, ABSTAIN] = 1 - often - tiny

    def responsibilities(self, patterns: np.ndarray) -> np.ndarray:
        """Probability of each class for each row of votes."""
        score = np.log(self.share)[None] + sum(np.log(self.theta[r])[:, patterns[:, r]].T for r in range(len(RULES)))
        score = np.exp(score - score.max(axis=1, keepdims=True))
        return score / score.sum(axis=1, keepdims=True)

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability of the good class for each row of votes."""
        return self.responsibilities(patterns)[:, 0] if len(patterns) else np.zeros(0)

    def fit(self, patterns: np.ndarray, weights: np.ndarray) -> Model:
        total = float(weights.sum())
        if not total:
            return self
        prior_share = self.share * PRIOR_SHARE
        prior = self.theta * (prior_share * total)[None, :, None]
        for _ in range(ITERATIONS):
            p = self.responsibilities(patterns) * weights[:, None]
            share = (p.sum(axis=0) / total + prior_share) / (1 + PRIOR_SHARE)
            theta = prior.copy()
            for r in range(len(RULES)):
                for v in range(3):
                    theta[r, :, v] += p[patterns[:, r] == v].sum(axis=0)
            theta /= theta.sum(axis=2, keepdims=True)
            for k, r in enumerate(self.kinds, 1):
                if theta[r, k, BAD] < MIN_OWN:
                    theta[r, k] *= (1 - MIN_OWN) / (1 - theta[r, k, BAD])
                    theta[r, k, BAD] = MIN_OWN
            moved = max(float(np.abs(share - self.share).max()), float(np.abs(theta - self.theta).max()))
            self.share, self.theta = share, theta
            if moved < 1e-9:
                break
        return self

    def accuracies(self) -> dict[str, float]:
        """Each rule's probability of a right vote when it votes."""
        good, bad = self.theta[:, :1] * self.share[0], self.theta[:, 1:] * self.share[1:, None]
        right = good[:, :, GOOD].sum(axis=1) + bad[:, :, BAD].sum(axis=1)
        wrong = good[:, :, BAD].sum(axis=1) + bad[:, :, GOOD].sum(axis=1)
        return dict(zip(RULES, (right / (right + wrong)).tolist()))


def fit(voted: DataFrame, votes: str = "votes") -> tuple[Model, dict[str, float]]:
    """The fitted model and the posterior of each vote pattern met."""
    rows = voted.groupBy(votes).count().collect()  # 3 ** len(RULES) rows at most
    rows = sorted((r[0], r[1]) for r in rows)
    index = {v: i for i, v in enumerate(VOTES)}
    patterns = np.array([[index[v] for v in p] for p, _ in rows], np.int64).reshape(len(rows), len(RULES))
    model = Model().fit(patterns, np.array([n for _, n in rows], float))
    return model, dict(zip([p for p, _ in rows], model.posterior(patterns).tolist()))


def with_posterior(voted: DataFrame, votes: str = "votes", posterior: str = "posterior") -> DataFrame:
    """``voted`` with the fitted probability that the text is good."""
    _, by_pattern = fit(voted, votes)
    rows = [(p, good) for p, good in by_pattern.items()]
    verdicts = voted.sparkSession.createDataFrame(rows, f"`{votes}` string, `{posterior}` double")
    return voted.drop(posterior).join(F.broadcast(verdicts), votes, "left")  # as many rows as patterns, a bound known beforehand

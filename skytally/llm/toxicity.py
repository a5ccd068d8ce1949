"""Toxicity of texts whose words may be disguised.

1. A character trigram model is counted over the words of all documents.
2. Noisy channel: a token that is not plainly a word becomes a lattice. A
   look-alike character may stand for a letter, a repeated letter may be one,
   signs within a word may be nothing, and the spaces of a run of single
   characters may be the writer's or not. Viterbi decoding finds the reading
   that the character model and the channel's costs together make likeliest.
3. Words and character 4-grams of the readings, and of the tokens as they
   stand, are the features of a logistic model. It is fitted on a sample of at
   most about ``SAMPLE`` labelled rows and scores whole texts.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.llm.common import MEMO_KEY, TASK_ROWS, Memo, arrow_map, lasting, map_texts

# Characters that are written for letters.
LOOK_ALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¢": "c", "¥": "y",
    "*": "aeiou",
}
#: Negative logs of channel probabilities.
STAND_IN, DROPPED_SIGN, DROPPED_REPEAT, DROPPED_SPACE, DROPPED_OTHER = 1.2, 0.7, 0.5, 0.2, 9.0
#: Look-alikes that may end a word or open one as punctuation too.
SPARED = "(<*|!$@€£¢¥+"
SIGNS = frozenset(".-_'*~^,:;/\\\"`´’")

#: Trigrams that the character model keeps, the most frequent; all others back off.
TRIGRAMS = 1 << 17
SAMPLE = 40_000
FEATURES = 8192
LEAST_DOCS, LEAST_LOG_ODDS = 4, 1.5
THRESHOLD = 0.7
#: Tokens whose features a worker remembers, in each of two generations.
MEMO_TOKENS = 60_000
#: Names that a task counts before it hands them on.
FLUSH = 200_000
#: Characters of the texts that are read together; a longer text is read alone.
CHUNK = 1 << 18
#: Tokens whose trigrams are counted together.
PIECE = 1 << 16

#: Punctuation before and after a word. Some of it is also written for letters.
LEADING = frozenset("\"'([{<«‘“¿¡#>*_~|-")
TRAILING = frozenset(".,;:?!\"')]}>»’”|")
#: Of these one is punctuation whatever is spared.
CLOSING = (".", ",", ";", ":", "?")
#: Negative log of the probability that a sign at a word's end is punctuation.
DROPPED_EDGE = 0.3
#: Of a look-alike that follows itself: it stands for a letter again, or is drawn out.
STAND_IN_AGAIN, DROPPED_AGAIN = 0.1, 0.8
_DOUBLE = re.compile(r"(.)\1")
_RUN = re.compile(r"(.)\1+")
_TRIPLE = re.compile(r"(.)\1\1")
_DOUBLES = re.compile(r"(.)\1.*(.)\2")


class Model(NamedTuple):
    trigrams: dict[str, int]
    features: dict[str, int]
    weights: np.ndarray
    bias: float


def _is_sign(character: str) -> bool:
    return not (character.isalnum() or character == "_" or character.isspace())


def stripped(token: str, spared: str = "") -> str:
    """The token in lower case without quotes, brackets, punctuation and doubled signs at its ends.

    One walk from either end, however long the runs of signs are. Signs in ``spared`` stay.
    """
    word = token.lower()
    if word.isalpha():
        return word
    if word[-1:] in CLOSING and word[:-1].isalpha():
        return word[:-1]
    start, end = 0, len(word)
    while start < end and word[start] in LEADING and word[start] not in spared:
        start += 1
    while end > start:
        last = word[end - 1]
        doubled = end - start > 1 and word[end - 2] == last or end < len(word) and word[end] == last
        if last in spared or not (last in TRAILING or doubled and _is_sign(last)):
            break
        end -= 1
    return word[start:end]


def is_plain(word: str) -> bool:
    """Whether the word can be read as it stands: letters only, no letter drawn out."""
    return word.isalpha() and not _TRIPLE.search(word) and not (len(word) > 5 and _DOUBLES.search(word))


# --- character model -------------------------------------------------------------


def _chunks(texts: list):
    """Slices of the list of at most ``CHUNK`` characters, or of one text."""
    start = size = 0
    for n, text in enumerate(texts):
        size += len(text or "")
        if size > CHUNK and n > start:
            yield slice(start, n)
            start, size = n, len(text or "")
    if start < len(texts):
        yield slice(start, len(texts))


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class _Plain:
    """Which code points are letters, and which plain word a token with other signs is (or none). Each is asked for once."""

    def __init__(self):
        self.kinds = np.zeros(0x110000, np.int8)
        self.words = Memo(self._word, 1 << 14)

    def letters(self, points: np.ndarray) -> np.ndarray:
        kinds = self.kinds[points]
        if not kinds.all():
            for point in np.unique(points[kinds == 0]).tolist():
                self.kinds[point] = 1 if chr(point).isalpha() else -1
            kinds = self.kinds[points]
        return kinds > 0

    @staticmethod
    def _word(token: str) -> str:
        word = stripped(token)
        return word if word.isalpha() and not _TRIPLE.search(word) else ""


def _trigrams(tokens: list[str], known: _Plain) -> tuple[np.ndarray, np.ndarray]:
    """Character trigrams of the plain words among tokens in lower case as numbers of 63 bits, and their counts."""
    # Two spaces before each token, one after the last: what is no letter of a plain word becomes a space too.
    points = _points("  " + "  ".join(tokens) + " ")
    letter, space = known.letters(points), points == 32
    borders = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, ends = borders[::2], borders[1::2]
    lengths = ends - starts
    strange = np.bincount(np.searchsorted(ends, np.flatnonzero(~(letter | space)), side="right"), minlength=len(tokens))
    closed = (strange == 1) & (lengths > 1) & np.isin(points[ends - 1], [ord(c) for c in CLOSING])
    simple = (strange == 0) | closed
    plain = simple.copy()
    tripled = np.flatnonzero((points[:-2] == points[1:-1]) & (points[1:-1] == points[2:]) & letter[:-2])
    plain[np.searchsorted(ends, tripled, side="right")] = False
    points = np.where(letter & np.append(np.repeat(plain, lengths + 2), False), points, np.uint32(32))
    others = [word for n in np.flatnonzero(~simple).tolist() if (word := known.words[tokens[n]])]
    if others:
        points = np.concatenate([points, _points("  " + "  ".join(others) + " ")])
    points = points.astype(np.int64)
    first, second, third = points[:-2], points[1:-1], points[2:]
    at = np.flatnonzero((second != 32) | (first == 32) & (third != 32))
    return np.unique(first[at] << 42 | second[at] << 21 | third[at], return_counts=True)


def trigram_counts(docs: DataFrame, most: int = TRIGRAMS) -> dict[str, int]:
    """Counts of character trigrams over the plain words of all texts; a space is a word's border."""

    def counted(batches):
        known, grams, low = lasting(_Plain), Counter(), (1 << 21) - 1

        def flushed():
            names = [chr(g >> 42) + chr(g >> 21 & low) + chr(g & low) for g in grams]
            made = pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(grams.values(), pa.int64())], names=["gram", "n"])
            grams.clear()
            return made

        for batch in batches:
            for start in range(0, batch.num_rows, TASK_ROWS):
                texts = batch.column(0).slice(start, TASK_ROWS).to_pylist()
                for chunk in _chunks(texts):
                    tokens = " ".join([text for text in texts[chunk] if text]).lower().split()
                    for at in range(0, len(tokens), PIECE):
                        codes, totals = _trigrams(tokens[at : at + PIECE], known)
                        grams.update(dict(zip(codes.tolist(), totals.tolist())))
                if len(grams) > FLUSH:
                    yield flushed()
        yield flushed()

    counts = arrow_map(docs.select("text"), counted, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return {row.gram: row.n for row in counts.orderBy(F.desc("n"), "gram").limit(most).collect()}


def _opening(characters: str) -> str:
    """The letters at the start of which none follows itself."""
    last = ""
    for n, character in enumerate(characters):
        if character == last or not character.isalpha():
            return characters[:n]
        last = character
    return characters


class Restorer:
    """Viterbi decoding of disguised tokens under a character trigram model."""

    def __init__(self, trigrams: dict[str, int]):
        self.three = trigrams
        self.two, self.one, self.context, self.single = Counter(), Counter(), Counter(), Counter()
        for gram, n in trigrams.items():
            self.context[gram[:2]] += n
            self.two[gram[1:]] += n
            self.single[gram[1]] += n
            self.one[gram[2]] += n
        self.total = sum(self.one.values()) or 1
        self.cost = Memo(self._cost, 1 << 18)
        self.endings = Memo(self._ending, 1 << 14)
        self.kept = Memo(self._kept, 1 << 14)
        self.rests = Memo(self._rests, 1 << 14)

    def _cost(self, gram: str) -> float:
        """Negative log of the third character's probability after the first two."""
        p = 0.1 * (self.one[gram[2]] + 0.01) / self.total
        if self.single[gram[1]]:
            p += 0.3 * self.two[gram[1:]] / self.single[gram[1]]
        if self.context[gram[:2]]:
            p += 0.6 * self.three.get(gram, 0) / self.context[gram[:2]]
        return -math.log(p)

    def _readings(self, characters: str, i: int, first: int, last: int):
        """What the character at ``i`` may stand for, with the channel's cost; signs before first and after last may be punctuation."""
        c = characters[i]
        if c == " ":
            yield from ((" ", 0.0), ("", DROPPED_SPACE))
        elif c.isalpha():
            yield c, 0.0
            if i and characters[i - 1] == c:
                yield "", DROPPED_REPEAT
        else:
            again = i > 0 and characters[i - 1] == c
            for letter in LOOK_ALIKES.get(c, ""):
                yield letter, STAND_IN_AGAIN if again else STAND_IN
            if not first <= i <= last and (c in LEADING if i < first else c in TRAILING):
                yield "", DROPPED_EDGE
            elif again and c in LOOK_ALIKES:
                yield "", DROPPED_AGAIN
            else:
                yield "", DROPPED_SIGN if c in SIGNS else DROPPED_OTHER

    def decode(self, characters: str) -> str:
        """The likeliest reading; words in it are parted by spaces.

        Letters that open it and do not follow themselves have one reading. How
        the rest is read depends on no more than the last two of them.
        """
        opening = _opening(characters)
        return (opening + self.endings[("  " + opening)[-2:] + characters[len(opening) :]]).strip()

    def _ending(self, shown: str) -> str:
        """The likeliest reading of what follows the first two characters: letters, or spaces where nothing precedes."""
        cost, characters = self.cost, shown[1:]
        inner = [i for i, c in enumerate(characters) if c.isalnum()] or [1]
        # By the last two characters of the reading: its cost and its backward chain of characters.
        best: dict[str, tuple[float, tuple | None]] = {shown[:2]: (0.0, None)}
        for i in range(1, len(characters)):
            readings = list(self._readings(characters, i, inner[0], inner[-1]))
            step: dict[str, tuple[float, tuple | None]] = {}
            for state, (spent, chain) in best.items():
                for letter, price in readings:
                    if not letter:
                        new, now, made = state, spent + price, chain
                    elif letter == " " and state[1] == " ":
                        continue
                    else:
                        new, now, made = state[1] + letter, spent + price + cost[state + letter], (letter, chain)
                        if letter == " ":
                            new = "  "
                    if new not in step or now < step[new][0]:
                        step[new] = (now, made)
            best = step or best
        ends = [(spent + (0.0 if state[1] == " " else cost[state + " "]), i, chain) for i, (state, (spent, chain)) in enumerate(best.items())]
        chain, out = min(ends)[2], []
        while chain is not None:
            out.append(chain[0])
            chain = chain[1]
        return "".join(reversed(out))

    def undoubled(self, word: str) -> str:
        """``decode`` of a word of letters alone.

        Only repeats are in doubt there. The reading always ends with the letter
        last seen, so each run of one letter is settled by its two neighbours.
        """
        out, at, shown = [], 0, f" {word} "
        for run in _RUN.finditer(word):
            start, end = run.span()
            out.append(word[at:start] + word[start] * self.kept[shown[start : end + 2]])
            at = end
        return "".join(out) + word[at:]

    def _kept(self, shown: str) -> int:
        """How many letters the run between the first and the last character is read as."""
        cost, before, letter, after, n = self.cost, shown[0], shown[1], shown[-1], len(shown) - 2
        inside = cost[letter * 3] if n > 2 else 0.0
        best, kept = (n - 1) * DROPPED_REPEAT + cost[before + letter + after], 1
        border = cost[before + letter * 2] + cost[letter * 2 + after]
        # Between two and all letters the price is linear in their number.
        for m in {2, n}:
            price = (n - m) * DROPPED_REPEAT + border + (m - 2) * inside
            if price < best:
                best, kept = price, m
        return kept

    def words_of(self, token: str) -> tuple[str, ...]:
        """The token as a word, and the words of its reading where it is not plainly one.

        Signs at its ends that may stand for letters are left to the lattice, and
        so is every doubled letter. As in ``decode``, no more than the last two
        letters of its opening tell what follows them.
        """
        token = token.lower()
        opening = _opening(token)
        if not opening or " " in token:
            return self._words_of(token)
        return tuple([opening + rest for rest in self.rests[("  " + opening)[-2:] + token[len(opening) :]]])

    def _rests(self, shown: str) -> tuple[str, ...]:
        opening = shown[:2].lstrip()
        return tuple(word[len(opening) :] for word in self._words_of(opening + shown[2:]))

    def _words_of(self, token: str) -> tuple[str, ...]:
        word, whole = stripped(token), stripped(token, SPARED)
        if word == whole and word.isalpha():
            read = self.undoubled(word) if _DOUBLE.search(word) else word
            return (word,) if read == word else (word, read)
        read = self.decode(whole).split() if whole else []
        return tuple(dict.fromkeys(w for w in (word, *read) if w))


def spaced_runs(tokens: list[str]):
    """Joined by spaces, each run of three or more single characters."""
    lengths = list(map(len, tokens))
    if lengths.count(1) < 3:
        return
    singles = [i for i, length in enumerate(lengths) if length == 1]
    start = 0
    for n in range(1, len(singles) + 1):
        if n == len(singles) or singles[n] != singles[n - 1] + 1:
            if n - start >= 3:
                yield " ".join(tokens[singles[start] : singles[n - 1] + 1]).lower()
            start = n


def restored(docs: DataFrame, trigrams: dict[str, int]) -> DataFrame:
    """``(doc_id, text)`` with every disguised token replaced by its reading; null stays null."""
    shared = docs.sparkSession.sparkContext.broadcast(trigrams)

    def setup():
        restorer = Restorer(shared.value)
        plain = lambda token: token if is_plain(stripped(token)) or not stripped(token) else restorer.decode(stripped(token))
        memo = Memo(plain, MEMO_TOKENS)

        def restore(text):
            if text is None:
                return (None,)
            tokens = text.split()
            out, at, n = [], 0, len(tokens)
            while at < n:
                end = at
                while end < n and len(tokens[end]) == 1:
                    end += 1
                if end - at >= 3:
                    out.append(restorer.decode(" ".join(tokens[at:end]).lower()))
                    at = end
                else:
                    out.append(memo[tokens[at]])
                    at += 1
            return (" ".join(out),)

        return restore

    return map_texts(docs, setup, {"text": "string"})


# --- classifier --------------------------------------------------------------------


def _features_of(word: str) -> list[str]:
    shown = f" {word} "
    return [word, *["~" + shown[i : i + 4] for i in range(len(shown) - 3)]]


class _Grams:
    """The character 4-grams among features, looked up for many words at once.

    Four characters are one number: only those that the features use count.
    """

    def __init__(self, features: dict[str, int]):
        grams = {name[1:]: n for name, n in features.items() if len(name) == 5 and name[0] == "~"}
        self.ids = np.zeros(0x110000, np.uint16)
        for n, character in enumerate(sorted(set("".join(grams)))):
            self.ids[ord(character)] = n + 1
        codes = self._codes("".join(grams))[::4]
        order = np.argsort(codes)
        self.codes, self.numbers = codes[order], np.array(list(grams.values()), np.int64)[order]
        # Most grams of a text are no feature: a table by 18 bits of a product tells so.
        self.likely = np.zeros(1 << 18, bool)
        self.likely[self._places(codes)] = True

    @staticmethod
    def _places(codes: np.ndarray) -> np.ndarray:
        return codes * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(46)

    def _codes(self, text: str) -> np.ndarray:
        ids = self.ids[_points(text)].astype(np.uint64)
        return ids[:-3] << np.uint64(48) | ids[1:-2] << np.uint64(32) | ids[2:-1] << np.uint64(16) | ids[3:]

    def of(self, words: list[str]):
        """Pairs of a word's place and the number of a feature it has."""
        if not words or not len(self.codes):
            return ()
        codes = self._codes("".join([f" {word} " for word in words]))
        ends = np.cumsum([len(word) + 2 for word in words])
        likely = self.likely[self._places(codes)]
        for n in (1, 2, 3):  # a gram lies within one word
            likely[ends[:-1] - n] = False
        places = np.flatnonzero(likely)
        codes = codes[places]
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        hit = self.codes[at] == codes
        return zip(np.searchsorted(ends, places[hit], side="right").tolist(), self.numbers[at[hit]].tolist())


class _Reader:
    """Features of texts: their names, or the numbers of those that ``features`` lists."""

    def __init__(self, trigrams: dict[str, int], features: dict[str, int] | None = None):
        self.restorer = Restorer(trigrams)
        self.numbers = features
        self.grams = None if features is None else _Grams(features)
        self.young, self.old = {}, {}

    def tokens(self, texts: list) -> list[set[str]]:
        """The tokens of each text in lower case, and its runs of single characters as one token each."""
        found = []
        for text in texts:
            tokens = (text or "").lower().split()
            distinct = set(tokens)
            # The one character that is longer in lower case.
            distinct.update(spaced_runs(text.split() if text and "\u0130" in text else tokens))
            found.append(distinct)
        return found

    def words(self, tokens: list[str]) -> tuple[list[str], list[int]]:
        """The words of all tokens, as ``Restorer.words_of`` has them, and the places of their tokens."""
        words, owners, odd = [], [], []
        for n, token in enumerate(tokens):
            if not token.isalpha():
                if token[-1] not in CLOSING or not token[:-1].isalpha():
                    odd.append(n)
                    continue
                token = token[:-1]
            words.append(token)
            owners.append(n)
        restorer = self.restorer
        if words:
            points = _points(" ".join(words))
            ends = np.cumsum([len(word) + 1 for word in words])
            doubled = np.unique(np.searchsorted(ends, np.flatnonzero(points[1:] == points[:-1]), side="right"))
            for n in doubled.tolist():
                read = restorer.undoubled(words[n])
                if read != words[n]:
                    words.append(read)
                    owners.append(owners[n])
        for n in odd:
            token = tokens[n]
            for word in restorer.decode(token).split() if " " in token else restorer.words_of(token):
                words.append(word)
                owners.append(n)
        return words, owners

    def _read(self, tokens: list[str]) -> dict[str, tuple]:
        """The features of each token."""
        words, owners = self.words(tokens)
        found: dict[str, tuple] = dict.fromkeys(tokens, ())
        if self.grams is None:
            for word, n in zip(words, owners):
                found[tokens[n]] += tuple(_features_of(word))
            return found
        known = self.numbers
        for word, n in zip(words, owners):
            if word in known:
                found[tokens[n]] += (known[word],)
        for place, number in self.grams.of(words):
            token = tokens[owners[place]]
            if number not in found[token]:
                found[token] += (number,)
        return found

    def _chunk(self, texts: list) -> list[set]:
        texts = self.tokens(texts)
        if len(self.young) > MEMO_TOKENS:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        wanted = set().union(*texts)
        new = wanted.difference(young)
        again = old.keys() & new
        young.update([(token, old[token]) for token in again])
        made = self._read(list(new - again))
        young.update(made)
        telling = {token for token in wanted if young[token]}
        found = [set().union(*[young[token] for token in tokens & telling]) for tokens in texts]
        for token in made:
            if len(token) > MEMO_KEY:
                del young[token]
        return found

    def all_features(self, texts: list) -> list[set]:
        """The features of each text. Tokens that are new to the worker are read together."""
        return [found for chunk in _chunks(texts) for found in self._chunk(texts[chunk])]

    def features(self, text: str | None) -> set:
        return self._chunk([text])[0]


def _expanded(places: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place in a list of groups, which end at ``ends``: the members of that group, and the index of the place."""
    starts = np.concatenate([[0], ends[:-1]])
    sizes = (ends - starts)[places]
    at = np.repeat(np.arange(len(places)), sizes)
    within = np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return starts[places][at] + within, at


def _documents_with(reader: _Reader, texts: list, toxic: np.ndarray):
    """``(names, toxic, clean)``: words and then 4-grams of the texts, and how many toxic and clean texts have each."""
    texts = reader.tokens(texts)
    tokens = list(set().union(*texts))
    words, owners = reader.words(tokens)
    if not words:
        return
    # Texts to tokens, tokens to words, words to grams: each step lists members by group.
    place = {token: n for n, token in enumerate(tokens)}
    sizes = [len(t) for t in texts]
    of_token = np.fromiter((place[token] for t in texts for token in t), np.int64, sum(sizes))
    text = np.repeat(np.arange(len(texts)), sizes)
    ids: dict[str, int] = {}
    number = np.array([ids.setdefault(word, len(ids)) for word in words], np.int64)
    number = number[np.argsort(owners, kind="stable")]
    member, at = _expanded(of_token, np.cumsum(np.bincount(owners, minlength=len(tokens))))

    def counts(rows, columns, n):
        has = np.zeros((len(texts), n), bool)
        has[rows, columns] = True
        return has[toxic].sum(0).tolist(), has[~toxic].sum(0).tolist()

    text, word = text[at], number[member]
    names = list(ids)
    yield names, *counts(text, word, len(names))
    lengths = np.array([len(name) for name in names])
    points = _points("".join([f" {name} " for name in names])).astype(np.int64)
    inside = np.ones(len(points), bool)  # the last three characters of a word start no gram of it
    ends = np.cumsum(lengths + 2)
    for n in (1, 2, 3):
        inside[ends - n] = False
    # Pairs of characters are numbered first, so that a gram is one number whatever the alphabet.
    _, pairs = np.unique(points[:-1] << 21 | points[1:], return_inverse=True)
    starts = np.flatnonzero(inside)
    _, first, gram = np.unique(pairs[starts] << 32 | pairs[starts + 2], return_index=True, return_inverse=True)
    member, at = _expanded(word, np.cumsum(lengths - 1))
    shown = points[starts[first][:, None] + np.arange(4)].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
    names = ["~" + shown[n : n + 4] for n in range(0, len(shown), 4)]
    yield names, *counts(text[at], gram[member], len(names))


def _feature_counts(sample: DataFrame, trigrams) -> DataFrame:
    """``(feature, toxic, clean)``: documents of sample(text, toxic) that have the feature."""

    def counted(batches):
        reader = lasting(lambda: _Reader(shared.value))
        counts = (Counter(), Counter())

        def flushed():
            names = list(dict.fromkeys([*counts[0], *counts[1]]))
            columns = [[c[name] for name in names] for c in (counts[1], counts[0])]
            for c in counts:
                c.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), *[pa.array(c, pa.int64()) for c in columns]], names=["feature", "toxic", "clean"]
            )

        for batch in batches:
            for start in range(0, batch.num_rows, TASK_ROWS):
                part = batch.slice(start, TASK_ROWS)
                texts, toxic = part.column(0).to_pylist(), np.array(part.column(1).to_pylist(), bool)
                for chunk in _chunks(texts):
                    for names, *found in _documents_with(reader, texts[chunk], toxic[chunk]):
                        for count, of in zip(counts, reversed(found)):
                            count.update({name: n for name, n in zip(names, of) if n})
                    if len(counts[0]) + len(counts[1]) > FLUSH:
                        yield flushed()
        yield flushed()

    shared = sample.sparkSession.sparkContext.broadcast(trigrams)
    parts = arrow_map(sample.select("text", "toxic"), counted, "feature string, toxic long, clean long")
    return parts.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _logistic(rows: list[list[int]], labels: np.ndarray, size: int) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic model on present features, with a Gaussian prior."""
    lengths = np.array([len(r) for r in rows])
    row = np.repeat(np.arange(len(rows)), lengths)
    column = np.fromiter((f for r in rows for f in r), np.int64, int(lengths.sum()))
    weights, bias = np.zeros(size), math.log((labels.sum() + 0.5) / (len(labels) - labels.sum() + 0.5))
    speed, speed_bias = np.zeros(size), 0.0
    # The curvature of the log-likelihood along a feature is at most a quarter of its documents times its company.
    company = np.bincount(column, weights=lengths[row].astype(float), minlength=size) / 4 + 1.0
    for _ in range(2000):
        margin = bias + np.bincount(row, weights=weights[column], minlength=len(rows))
        error = labels - 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
        gradient = np.bincount(column, weights=error[row], minlength=size) - 0.02 * weights
        speed = 0.9 * speed + gradient / company
        speed_bias = 0.9 * speed_bias + error.sum() / (len(rows) / 4 + 1.0) * 0.5
        weights += speed
        bias += speed_bias
    return weights, bias


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on documents(doc_id, text) and labels(doc_id, toxic).

    The character model covers all documents. The classifier takes labelled
    documents by a hash of their id until about ``sample``. Labels with a null
    are left out; an id labelled more than once is toxic if any label says so.
    Without labelled documents every text scores one half.
    """
    trigrams = trigram_counts(docs)
    marked = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = min(1.0, sample / max(1, marked.count()))
    chosen = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).limit(2 * sample)
    chosen = chosen.select("doc_id", (F.col("toxic") > 0).cast("int").alias("toxic"))
    # At most 2 * sample rows of two numbers.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic")
    totals = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if not totals:
        return Model(trigrams, {}, np.zeros(0), 0.0)
    odds = F.log((F.col("toxic") + 0.5) / (totals.get(1, 0) + 1)) - F.log((F.col("clean") + 0.5) / (totals.get(0, 0) + 1))
    best = (
        _feature_counts(rows, trigrams)
        .withColumn("odds", odds)
        .where((F.col("toxic") >= LEAST_DOCS) & (F.col("odds") >= LEAST_LOG_ODDS))
        .orderBy(F.desc(F.col("toxic") * F.col("odds")), "feature")
        .limit(FEATURES)
    )
    features = {row.feature: n for n, row in enumerate(best.collect())}
    shared = docs.sparkSession.sparkContext.broadcast((trigrams, features))

    def seen(batches):
        reader = lasting(lambda: _Reader(*shared.value))
        for batch in batches:
            for start in range(0, batch.num_rows, TASK_ROWS):
                part = batch.slice(start, TASK_ROWS)
                found = [sorted(f) for f in reader.all_features(part.column(0).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found, pa.list_(pa.int32())), part.column(1)], names=["features", "toxic"]
                )

    # At most 2 * sample rows of the chosen features.
    table = arrow_map(rows.select("text", "toxic"), seen, "features array<int>, toxic int").collect()
    weights, bias = _logistic([r.features for r in table], np.array([r.toxic for r in table], float), len(features))
    return Model(trigrams, features, weights, bias)


def _scorer(model: Model):
    """Function from texts to their scores."""
    reader, weights = _Reader(model.trigrams, model.features), model.weights.tolist()

    def scored(texts):
        scores = []
        for features in reader.all_features(texts):
            total = 0.0
            for feature in sorted(features):
                total += weights[feature]
            margin = model.bias + total
            scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, margin)))))
        return scores

    return scored


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score)`` of every whole text, one row per row.

    Null and empty texts have no features and score as the model's bias does.
    Other columns are ignored, an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def mapped(batches):
        scored = lasting(lambda: _scorer(shared.value))
        for batch in batches:
            for start in range(0, batch.num_rows, TASK_ROWS):
                part = batch.slice(start, TASK_ROWS)
                scores = pa.array(scored(part.column(1).to_pylist()), pa.float64())
                yield pa.RecordBatch.from_arrays([part.column(0), scores], names=["doc_id", "score"])

    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), mapped, "doc_id long, score double")


def accepted(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, all columns, whose text scores below the threshold; nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")

    def kept(batches):
        scored = lasting(lambda: _scorer(shared.value))
        for batch in batches:
            for start in range(0, batch.num_rows, TASK_ROWS):
                part = batch.slice(start, TASK_ROWS)
                below = [score < threshold for score in scored(part.column(place).to_pylist())]
                yield part.filter(pa.array(below, pa.bool_()))

    return arrow_map(docs, kept, docs.schema)

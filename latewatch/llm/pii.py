"""Personal data: fixed patterns, and a conditional random field for the forms that patterns miss.

Base spans are emails, IPs, card and phone numbers by pattern, searched in linear time. A linear-chain conditional
random field over word shapes adds spans in other forms (``name [at] host [dot] org``, ``anna at example dot org``,
``(555) 123-4567``): it is trained here, by gradient ascent on the likelihood of a labelled table, and decoded by Viterbi over
all sequences of a batch at once in numpy. The table has some rows written by hand and some hundred that sentences and
fillers make by a seeded rule; sentences of another set make the held-out rows that the tests measure it on. A sequence is a
run of words around those with a digit, an at-sign or an opening bracket (two words on either side) or around a lone at-sign
or a cue word such as ``dot`` or ``phone`` (four words); words further away are no personal data by definition. A span found so must still
have what its kind needs: an email an at and a dot; an IP four numbers up to 255; a card 13 to 19 digits that pass Luhn's
check, or, if they fail it, stand right after a word for a card (a mistyped number still tells most of it; any other number
that fails is no card); a phone 7 to 15 digits, not grouped 3-2-4 as a social security number is.
It gives way to base spans that it overlaps.

Texts are read whole, batch by batch, without a shuffle; the model is a few kB.

Defined results: null and empty texts have no spans; repeated rows get equal spans; an empty table gives an empty
result; other columns are not read. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latewatch.llm.inputs import by_size, texts

KINDS = ("email", "ip", "card", "phone")

# ---------------------------------------------------------------- base spans

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)+")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile("[0-9]+")
_ANY = re.compile(r"[0-9@\[({]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each at-sign, the letters of a local part before it (not before the last span's end) and a domain after it."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", max(at + 1, free))


def ips(text: str) -> Iterator[tuple[int, int]]:
    """Numbers between dots, four by four from the left of a run of them."""
    for run in _DOTTED.finditer(text):
        numbers = [m.span() for m in _DIGITS.finditer(text, run.start(), run.end())]
        for k in range(0, len(numbers) - 3, 4):
            if all(b - a <= 3 and int(text[a:b]) <= 255 or int(text[a:b].lstrip("0")[:4] or 0) <= 255 for a, b in numbers[k : k + 4]):
                yield numbers[k][0], numbers[k + 3][1]


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if k % 2 == 0 else (2 * n - 9 if n > 4 else 2 * n)
    return total % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= sum(map(len, _DIGITS.findall(m.group()))) <= 15:
            yield m.span()


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans by pattern, by kind and place."""
    out = []
    if "@" in text:
        out += [("email", *s) for s in emails(text)]
    if _DIGITS.search(text):
        out += [("ip", *s) for s in ips(text)]
        out += [("card", *s) for s in cards(text)]
        if "+" in text:
            out += [("phone", *s) for s in phones(text)]
    return out


# ---------------------------------------------------------------- word shapes

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_RUNS = re.compile(r"[0-9]+|[a-z]+|[A-Z]+|[^\W\d_]+|.", re.S)
CUES = frozenset(
    "at dot (at) [at] {at} (dot) [dot] {dot} mail email e-mail write phone tel call fax mobile card visa mastercard amex ip address "
    "host server ssn isbn order version".split()
)
# Cue words that open a sequence by themselves: what stands near them may have neither digit nor at-sign.
_OPENING = re.compile(r"(?<![^\x20\x09-\x0D])[(\[{]?(?:dot|e-?mail|phone|tel|fax|mobile|visa|mastercard|amex)[)\]}:.,]?(?![^\x20\x09-\x0D])", re.I)
#: Runs up to which a shape is spelled out; longer words are told by which kinds of runs they have.
SPELLED = 24


def shape(word: str, exact: bool) -> str:
    """Letters, digits and others run by run over the whole word; digits with their number (up to 9) if ``exact``."""
    out = []
    for run in _RUNS.findall(word):
        if run[0].isdigit() and run.isascii():
            out.append(f"d{min(len(run), 9)}" if exact else "d")
        elif run[0].isalpha():
            out.append("a" if run.islower() else "A")
        else:
            out.append(run)
    return "".join(out) if len(out) <= SPELLED else "long " + "".join(sorted({o[0] for o in out if o[0] in "aAd"}))


_GLUED = re.compile(r"[\[({]at[\])}]")


def own_features(word: str) -> list[str]:
    """Features of one word: its shapes, its cue, its digits."""
    bare = word.strip(".,;:!?\"'").lower()
    digits = sum(c.isdigit() for c in word)
    out = [f"x={shape(word, True)}", f"s={shape(word, False)}", f"n={min(digits, 17) if digits < 8 else digits // 3 + 6}"]
    if bare in CUES:
        out.append(f"c={bare}")
    if not digits and bare.isalpha():
        out.append("plain")
    if "@" in word or "at" in bare and _GLUED.search(bare):
        out.append("glued")
    return out


def features(words: list[str], k: int) -> list[str]:
    """Features of a word with its neighbours' shapes and cues."""
    out = ["1", *own_features(words[k])]
    for step, name in ((-1, "p"), (1, "f"), (-2, "pp"), (2, "ff")):
        j = k + step
        out += [name + f for f in (own_features(words[j])[1:] if 0 <= j < len(words) else ["none"])]
    return out


# ---------------------------------------------------------------- the labelled table

# A span is written {kind|its words}; everything else is no personal data.
LABELLED = (
    "write to {email|anna.kern@mail.example.org} before noon",
    "write to {email|anna [at] example [dot] org} before noon",
    "please contact {email|j.doe (at) mail (dot) example (dot) com} or come by",
    "my mail is {email|bob [at] host [dot] net} and no other",
    "mail: {email|carl(at)firm(dot)com} is read daily",
    "answers go to {email|team[at]lab[dot]edu} only",
    "send it to {email|x.y [at] example.com} soon",
    "please write to {email|maria at firma dot com} before ten",
    "we write to {email|otto at labor dot de} about it",
    "ask {email|jane dot doe at host dot net} first",
    "letters to {email|peter at school dot edu} are late",
    "drop {email|eva at casa dot es} a line",
    "ask {email|maria.lopez {at} correo {dot} es} for it",
    "the office [room 4] is at the end (left)",
    "we met (at noon) in the hall [dot plot]",
    "see [12] and [at] the end of page 4",
    "figure (a) and [b] show the dot product at 3",
    "call {phone|(555) 123-4567} after five",
    "call {phone|555-123-4567} after five",
    "tel {phone|(212) 555-0199} is the desk",
    "phone {phone|020 7946 0958} or mail",
    "the number {phone|+1 (974) 555-3436} was busy",
    "reach us under {phone|+49 30 901820} until six",
    "fax {phone|212-555-0142} still works",
    "mobile {phone|0170 555 0123} on weekends",
    "tel: {phone|415.555.0134} for orders",
    "(312) is the code and 1999 the year",
    "in 1998 about 120 of 4500 came by",
    "from 1914-1918 and 1939-1945 at war",
    "version 2.10.4 came in 2021 with 30 fixes",
    "it cost 1,299.00 in 2019 and 999 today",
    "pages 100-120 and 200-231 were lost",
    "the score was 3-2 after 90 minutes",
    "section 4.2.1 lists 17 items and 2 notes",
    "open 10-12 and 14-18 on day 3",
    "order 20394857 was sent on 2020-11-05",
    "on 05/11/2020 at 10:45 it rained",
    "isbn 978-3-16-148410-0 is out of print",
    "part 555-123 fits model 4567 too",
    "a ratio of 1234 to 5678 was seen",
    "card {card|4111 1111 1111 1111} was charged",
    "visa {card|4012-8888-8888-1881} was charged",
    "my card is {card|5555555555554444} for now",
    "mastercard {card|5105 1051 0510 5100} expires soon",
    "amex {card|3782 822463 10005} was refused",
    "the id 4845168114407329 is not known",
    "run 9807915762804490 ended well",
    "sum 1219312 and 4473012014 were off",
    "host {ip|192.168.10.24} is down",
    "server {ip|10.0.0.7} answers again",
    "ip {ip|172 . 16 . 254 . 1} was typed so",
    "address {ip|83.229.25.121:8080} was scanned",
    "blocked {ip|203.0.113.9/24} last night",
    'set token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" there',
    'key "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde" was found',
    "hash 9233a8ecf7c5b09fe5949719b6b82bc439e9329b of x1",
    "user@ and @name are handles of 2 kinds",
    "the (very) long [old] road {and} more",
    "ask @anna or @bob about 3 things",
    "7 of 9 came with 100% at 8.30",
    "x1 y2 z3 a4 b5 c6 of 77",
    "thand 9. erth 12. of the 3.",
    "rows 1 2 3 4 5 6 7 8 of 12",
    "14 15 16 17 and 555 more",
    "in 2020 some 555 1234 others came",
)
_MARK = re.compile(r"\{(email|ip|card|phone)\|((?:[^{}]|\{[a-z]+\})*)\}")
LABELS = ("O", *[f"{p}-{k}" for k in KINDS for p in "BI"])


# Sentences whose slots are filled by the rules below, one set for training and one to measure on. Fixed values.
TRAINING_SENTENCES = (
    "please write to {email} before friday", "you can reach {email} at any time", "for questions mail {email} or ask at the desk",
    "my address is {email} and i read it daily", "send the form to {email} please", "contact : {email} ( office )",
    "the author , {email} , answers slowly", "we met at noon and she said {email} was hers", "e-mail {email} for the list",
    "call {phone} after five", "tel {phone} or come by", "her number is {phone} at home", "phone: {phone} ( mornings )",
    "fax {phone} still works", "you can text {phone} for help", "ring {phone} and ask for anna", "mobile {phone} on weekends",
    "the card {card} was charged twice", "visa {card} expires soon", "he paid with {card} in may", "card number {card} was refused",
    "mastercard {card} on file", "please bill {card} for the rest", "the host {ip} is down", "server {ip} answers again",
    "blocked {ip} last night", "login from {ip} at 10:45", "ping {ip} gave no answer", "address {ip} was scanned", "the machine at {ip} is slow",
    "requests from {ip} rose", "it came from {ip} once", "look at {ip} first", "the box at {ip} hangs",
    "mail : {email} bye", "drop {email} a line", "from {email} we heard nothing", "the news reached {email} before noon", "{email}",
    "by {email} or in person", "a note to {email} now", "through {email} or not at all", "ask {email} for the room", "by post , {email} , or fax",
    "{email} and {phone} are both on the card", "write {email} or call {phone} today",
)
MEASURING_SENTENCES = (
    "if you like the plan , drop a note to {email} soon", "orders go through {email} only", "she signs as {email} in letters",
    "my mail : {email} thanks", "all replies reached {email} by monday", "ask {email} about the keys", "reach me on {phone} tonight",
    "the desk has phone {phone} now", "dial {phone} for a taxi", "his office , {phone} , is closed", "call us : {phone} or visit",
    "they kept {card} on record", "amex {card} was stolen", "the payment from {card} bounced", "use card {card} for travel",
    "traffic came from {ip} again", "the router at {ip} restarted", "we saw host {ip} twice", "send it by {email} or by fax {phone} please",
)
PLAIN_SENTENCES = (
    "in {year} about {count} people came by", "it cost {amount} in {year}", "pages {range} were lost", "order {order} was sent on {date}",
    "isbn {isbn} is out of print", "ssn {ssn} is not shown", "version {version} came with {count} fixes", "the id {order} is not known",
    "on {date} at {time} it rained", "we met at the dot of noon", "look at the red dot on page {count}", "key {hex} was found",
    "the score was {count} - {count} after {count} minutes", "call it a day at {time}", "at {time} the phone rang twice",
    "a mail came at noon", "the visa was refused in {year}", "room {count} [ floor {count} ] is at the end", "see ({count}) and [{count}] there",
    "the sum {wrong} is not valid", "run {wrong} ended well", "my social security number {ssn} was on it", "from {range} and {range} at war",
)
MEASURING_PLAIN = (
    "around {year} some {count} ships sailed", "they asked {amount} for it", "read lines {range} first", "parcel {order} left on {date}",
    "the book , isbn {isbn} , is rare", "his ssn , {ssn} , was stolen", "release {version} has {count} bugs", "the meeting at {time} moved to {date}",
    "a dot at the end of line {count}", "token {hex} expired", "number {wrong} is no card", "she waited at the station at {time}",
    "no phone in {year} had {count} keys", "a visa for {count} days",
)


def _luhn_number(rng: random.Random, size: int, right: bool = True) -> str:
    digits = "".join([str(rng.choice((3, 4, 5, 6))), *[str(rng.randrange(10)) for _ in range(size - 2)]])
    last = next(d for d in "0123456789" if luhn(digits + d))
    return digits + (last if right else str((int(last) + rng.randrange(1, 10)) % 10))


def _grouped(digits: str, sizes: tuple[int, ...], by: str) -> str:
    ends = np.cumsum(sizes).tolist()
    return by.join(digits[a:b] for a, b in zip([0, *ends], [*ends, len(digits)]) if digits[a:b])


def filler(kind: str, rng: random.Random) -> str:
    """What stands in a slot."""
    def number(n: int) -> str:
        return str(rng.randrange(1, 10)) + "".join(str(rng.randrange(10)) for _ in range(n - 1))

    def name() -> str:
        return "".join(rng.choice(("an", "be", "co", "da", "el", "fi", "go", "hu", "ka", "mo", "ri", "su")) for _ in range(rng.randrange(2, 4)))

    if kind == "email":
        user = rng.choice((name(), f"{name()}.{name()}", f"{name()}{rng.randrange(100)}", f"{name()}_{name()}"))
        host, end = rng.choice((name(), f"{name()}-{name()}")), rng.choice(("com", "org", "net", "de", "es", "fr", "edu"))
        at, dot = rng.choice((("@", "."), (" [at] ", " [dot] "), (" (at) ", " (dot) "), (" {at} ", " {dot} "), (" at ", " dot "), (" at ", " dot "), (" AT ", " DOT "),
                              ("(at)", "(dot)"), ("[at]", "[dot]"), ("[at]", "."), (" [at] ", "."), (" @ ", " . ")))
        return f"{user}{at}{host}{dot}{end}" if rng.random() < 0.7 else f"{user}{at}{name()}{dot}{host}{dot}{end}"
    if kind == "phone":
        return rng.choice((
            f"({number(3)}) {number(3)}-{number(4)}", f"{number(3)}-{number(3)}-{number(4)}", f"{number(3)}.{number(3)}.{number(4)}",
            f"+{number(2)} {number(3)} {number(7)}", f"+1 ({number(3)}) {number(3)}-{number(4)}", f"0{number(2)} {number(4)} {number(4)}",
            f"0{number(3)} {number(3)} {number(4)}", f"({number(3)}){number(3)}-{number(4)}", f"0{number(3)}/{number(7)}",
        ))
    if kind == "card":
        digits = _luhn_number(rng, 16)
        return rng.choice((digits, *[_grouped(digits, (4, 4, 4), by) for by in (" ", "-", ".", "/")], _grouped(_luhn_number(rng, 15), (4, 6), " ")))
    if kind == "wrong":
        digits = _luhn_number(rng, 16, False)
        return rng.choice((digits, *[_grouped(digits, (4, 4, 4), by) for by in (" ", "-")]))
    if kind == "ip":
        parts = [str(rng.randrange(1, 256)) for _ in range(4)]
        return rng.choice((".".join(parts), " . ".join(parts), "[.]".join(parts), "(.)".join(parts)))
    return {
        "year": lambda: str(rng.randrange(1500, 2030)), "count": lambda: str(rng.randrange(1, 500)),
        "amount": lambda: f"{rng.randrange(1, 90)},{number(3)}.{rng.randrange(10, 100)}", "range": lambda: f"{number(3)}-{number(3)}",
        "order": lambda: number(rng.randrange(5, 13)), "date": lambda: f"{rng.randrange(1990, 2030)}-{rng.randrange(10, 13)}-{rng.randrange(10, 29)}",
        "time": lambda: f"{rng.randrange(10, 24)}:{rng.randrange(10, 60)}", "isbn": lambda: f"978-{number(1)}-{number(2)}-{number(6)}-{number(1)}",
        "ssn": lambda: f"{number(3)}-{number(2)}-{number(4)}", "version": lambda: f"{number(1)}.{number(1)}.{number(2)}",
        "hex": lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40)),
    }[kind]()


_SLOT = re.compile(r"\{([a-z]+)\}")


def labelled_rows(sentences: tuple[str, ...], plain: tuple[str, ...], times: int, seed: int) -> list[tuple[list[str], list[int]]]:
    """Words and labels of every sentence, so many times, with other fillers each time."""
    rng, out = random.Random(seed), []
    for sentence in (*sentences, *plain) * times:
        words: list[str] = []
        labels: list[int] = []
        for word in sentence.split():
            m = _SLOT.search(word)
            inside = (word[: m.start()] + filler(m.group(1), rng) + word[m.end() :]).split() if m else [word]
            first = LABELS.index(f"B-{m.group(1)}") if m and m.group(1) in KINDS else 0
            words += inside
            labels += [first, *[first + 1 if first else 0] * (len(inside) - 1)]
        out.append((words, labels))
    return out


def read_labelled(row: str) -> tuple[list[str], list[int]]:
    """Words and their labels."""
    words, labels, at = [], [], 0
    for m in _MARK.finditer(row):
        plain, inside = row[at : m.start()].split(), m.group(2).split()
        words += plain + inside
        first = LABELS.index(f"B-{m.group(1)}")
        labels += [0] * len(plain) + [first] + [first + 1] * (len(inside) - 1)
        at = m.end()
    rest = row[at:].split()
    return words + rest, labels + [0] * len(rest)


# ---------------------------------------------------------------- the field


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


class Field:
    """Weights of features by label and of label pairs."""

    def __init__(self, vocabulary: dict[str, int], emission: np.ndarray, pairs: np.ndarray) -> None:
        self.vocabulary, self.emission, self.pairs = vocabulary, emission, pairs
        self.parts: dict[tuple, np.ndarray] = {}

    def scores(self, words: list[str]) -> np.ndarray:
        """Label scores of each word of a sequence. What words with equal shapes and neighbours' shapes give is kept."""
        keys = [tuple(own_features(w)) for w in words]
        out = np.empty((len(words), len(LABELS)))
        for k in range(len(words)):
            around = (*(keys[j] if 0 <= j < len(keys) else () for j in range(k - 2, k + 3)),)
            if (found := self.parts.get(around)) is None:
                ids = [self.vocabulary[f] for f in features(words, k) if f in self.vocabulary]
                found = self.emission[ids].sum(axis=0)
                if len(self.parts) < 100_000:
                    self.parts[around] = found
            out[k] = found
        return out


def training_rows(times: int = 12, seed: int = 7) -> list[tuple[list[str], list[int]]]:
    """The labelled table: rows written by hand, and those of the training sentences."""
    return [*map(read_labelled, LABELLED), *labelled_rows(TRAINING_SENTENCES, PLAIN_SENTENCES, times, seed)]


def train(rows: list[tuple[list[str], list[int]]] | None = None, rounds: int = 120, penalty: float = 0.03, rate: float = 0.1) -> Field:
    """Maximises the penalised likelihood of the labelled rows by Adam; forward and backward sums over all rows at once."""
    sequences = training_rows() if rows is None else rows
    vocabulary: dict[str, int] = {}
    longest, n_labels = max(len(w) for w, _ in sequences), len(LABELS)
    named = [[[vocabulary.setdefault(f, len(vocabulary)) for f in features(w, k)] for k in range(len(w))] for w, _ in sequences]
    n, at = len(sequences), [(i, t) for i, (w, _) in enumerate(sequences) for t in range(len(w))]
    sizes = np.array([len(named[i][t]) for i, t in at])
    row_of, row_start = np.repeat(np.arange(len(at)), sizes), np.cumsum(sizes) - sizes
    feature_of = np.concatenate([named[i][t] for i, t in at])
    by_feature = np.argsort(feature_of, kind="stable")
    feature_start = np.searchsorted(feature_of[by_feature], np.arange(len(vocabulary)))
    i_of, t_of = np.array([i for i, _ in at]), np.array([t for _, t in at])
    truth = np.zeros((len(at), n_labels))
    truth[np.arange(len(at)), [sequences[i][1][t] for i, t in at]] = 1
    lengths = np.array([len(w) for w, _ in sequences])
    true_pairs = np.zeros((n_labels, n_labels))
    for _, labels in sequences:
        np.add.at(true_pairs, (labels[:-1], labels[1:]), 1)
    theta = [np.zeros((len(vocabulary), n_labels)), np.zeros((n_labels, n_labels))]
    first, second = [np.zeros_like(x) for x in theta], [np.zeros_like(x) for x in theta]
    for turn in range(1, rounds + 1):
        emission, pairs = theta
        e = np.zeros((n, longest, n_labels))
        e[i_of, t_of] = np.add.reduceat(emission[feature_of], row_start)
        forward, backward = np.zeros_like(e), np.zeros_like(e)
        forward[:, 0] = e[:, 0]
        for t in range(1, longest):
            step = _log_sum(forward[:, t - 1, :, None] + pairs, 1) + e[:, t]
            forward[:, t] = np.where((t < lengths)[:, None], step, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            step = _log_sum(pairs + (e[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where((t + 1 < lengths)[:, None], step, 0)
        whole = _log_sum(forward[:, -1], 1)
        marginal = np.exp(forward + backward - whole[:, None, None])
        expected_pairs = np.zeros_like(pairs)
        for t in range(longest - 1):
            joint = forward[:, t, :, None] + pairs + (e[:, t + 1] + backward[:, t + 1])[:, None, :] - whole[:, None, None]
            expected_pairs += np.exp(joint[t + 1 < lengths]).sum(axis=0)
        slope_e = np.add.reduceat((truth - marginal[i_of, t_of])[row_of[by_feature]], feature_start)
        for k, slope in enumerate((slope_e - penalty * emission, true_pairs - expected_pairs - penalty * pairs)):
            first[k], second[k] = 0.9 * first[k] + 0.1 * slope, 0.99 * second[k] + 0.01 * slope**2
            theta[k] = theta[k] + rate * (first[k] / (1 - 0.9**turn)) / (np.sqrt(second[k] / (1 - 0.99**turn)) + 1e-6)
    return Field(vocabulary, *theta)


def viterbi(scores: np.ndarray, lengths: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Best labels of sequences that stand one after another, all decoded together, step by step."""
    if not len(lengths):
        return np.zeros(0, np.int64)
    order = np.argsort(-lengths, kind="stable")
    starts, sizes = (np.cumsum(lengths) - lengths)[order], lengths[order]
    back = np.zeros((len(scores), scores.shape[1]), np.int8)
    best = scores[starts].copy()
    alive = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), side="right")  # sequences with more than t words
    for t in range(1, sizes[0]):
        n = alive[t]
        step = best[:n, :, None] + pairs
        back[starts[:n] + t] = step.argmax(axis=1)
        best[:n] = step.max(axis=1) + scores[starts[:n] + t]
    out = np.zeros(len(scores), np.int64)
    label = best.argmax(axis=1)
    for t in range(sizes[0] - 1, -1, -1):
        n = alive[t]
        out[starts[:n] + t] = label[:n]
        if t:
            label[:n] = back[starts[:n] + t, label[:n]]
    return out


def _sequences(text: str) -> Iterator[list[tuple[int, int]]]:
    """Runs of words, as places, near words with a digit, an at-sign or an opening bracket, and near cue words."""
    places = [m.span() for m in _WORD.finditer(text)]
    cues = {m.start() for m in _OPENING.finditer(text)}
    marked = [(k, 4 if a in cues or text[a:b] == "@" else 2) for k, (a, b) in enumerate(places) if a in cues or _ANY.search(text, a, b)]
    first = last = -1
    for k, reach in marked:
        if first < 0:
            first, last = max(k - reach, 0), k + reach
        elif k - reach <= last + 1:
            first, last = min(first, max(k - reach, 0)), max(last, k + reach)
        else:
            yield places[first : last + 1]
            first, last = max(k - reach, last + 1), k + reach
    if first >= 0:
        yield places[first : last + 1]


_SOCIAL = re.compile(r"(?<![0-9])[0-9]{3}[- ][0-9]{2}[- ][0-9]{4}(?![0-9])")
_AT = re.compile(r"@|[\[({]\s*at\s*[\])}]|\sat\s")
_DOT = re.compile(r"\.|[\[({]\s*dot\s*[\])}]|\sdot\s")


_CARD_WORDS = frozenset(("card", "visa", "mastercard", "amex"))


def _fits(kind: str, text: str, before: str) -> bool:
    """Whether a decoded span has what its kind needs, ``before`` being the word before it."""
    numbers = _DIGITS.findall(text)
    if kind == "email":
        low = text.lower()
        return _AT.search(low) is not None and _DOT.search(low) is not None
    if kind == "ip":
        return len(numbers) >= 4 and all(len(n) <= 3 and int(n) <= 255 for n in numbers[:4])
    digits = "".join(numbers)
    if kind == "card":
        return 13 <= len(digits) <= 19 and (luhn(digits) or before.strip(_AROUND).lower() in _CARD_WORDS)
    return 7 <= len(digits) <= 15 and not _SOCIAL.search(text)


_AROUND = " \t\n\x0b\x0c\r.,;:!?\"'<>#*$%&"


def find_spans(values: list[str], field: Field) -> list[tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]]:
    """Of each text its base spans and the spans that the field adds."""
    base = [base_spans(t) if _ANY.search(t) else [] for t in values]
    held = [(k, s) for k, t in enumerate(values) if _ANY.search(t) or _OPENING.search(t) for s in _sequences(t)]
    added: list[list[tuple[str, int, int]]] = [[] for _ in values]
    if held:
        lengths = np.array([len(s) for _, s in held])
        scores = np.concatenate([field.scores([values[k][a:b] for a, b in s]) for k, s in held])
        labels = viterbi(scores, lengths, field.pairs)
        at = 0
        for (k, places), size in zip(held, lengths):
            names = labels[at : at + size]
            at += size
            j = 0
            while j < size:
                if not names[j]:
                    j += 1
                    continue
                kind, end = (names[j] - 1) // 2, j + 1
                while end < size and names[end] == 2 * kind + 2:
                    end += 1
                a, b = places[j][0], places[end - 1][1]
                inside = values[k][a:b]
                a += len(inside) - len(inside.lstrip(_AROUND))
                b -= len(inside) - len(inside.rstrip(_AROUND))
                free = all(b <= x or y <= a for _, x, y in base[k])
                before = values[k][slice(*places[j - 1])] if j else ""
                if a < b and free and _fits(KINDS[kind], values[k][a:b], before):
                    added[k].append((KINDS[kind], a, b))
                j = end
    return list(zip(base, added))


def written(spans: list[tuple[str, int, int]]) -> str:
    """``kind:start:end`` by kind as listed, then start, comma-joined."""
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


def annotate(docs: DataFrame, field: Field | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, base_spans, spans`` of every row: the spans by pattern, and all, as ``kind:start:end``, comma-joined."""
    field = field or train()
    rows = texts(docs, id_column, text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_size(batch, 1):
                found = find_spans(part.column(1).to_pylist(), field)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([written(b) for b, _ in found], pa.string()), pa.array([written(b + a) for b, a in found], pa.string())],
                    names=["doc_id", "base_spans", "spans"],
                )

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, base_spans string, spans string")


def digests(found: DataFrame) -> DataFrame:
    """Counts of the base spans by kind, their digest, and all spans."""
    return found.select(
        "doc_id",
        *[F.regexp_count("base_spans", F.lit(f"{k}:")).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"),
        "spans",
    )

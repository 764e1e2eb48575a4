"""Personal data: base patterns, and a skip-chain conditional random field over what looks like personal data.

Base spans are found by pattern and check (address parts, the Luhn sum, digit counts). Candidates are base spans and
looser matches: digit groups, written-out addresses, names of known mail addresses. They are the nodes of a field with
the labels of LABELS: neighbours in the text share a chain potential, distant nodes with equal or similar contents a
skip potential. Loopy message passing gives each node's label; looser matches that get one become spans, so a number
that a pattern misses is found where another mention of it, or its surroundings, tell what it is.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quillmill.llm.base import bounded_batches

KINDS = ("email", "ip", "card", "phone")
#: Kinds of spans: those of the base patterns, and credentials, which only the field finds.
ALL_KINDS = (*KINDS, "secret")
LABELS = ("none", *ALL_KINDS)
#: A looser match becomes a span if its label has this probability or more.
SURE = 0.9
#: Messages have settled if none changes by more, in nats; from round DAMPED on they move half way, so that they settle in loops too.
SETTLED, DAMPED = 1e-4, 50
#: Neighbours in the text are linked if so many characters or fewer lie between them.
NEAR = 120

Span = tuple[str, int, int]

# fixed values: the base patterns
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")

_GROUPS = re.compile(r"(?<![A-Za-z0-9])\+?\(?[0-9](?:[\x20().,/-]{0,2}[0-9]){6,}(?![A-Za-z0-9])")
_RUN = re.compile("[A-Za-z0-9._%+-]+")
_TOUCHES = re.compile(r"[\w@]")
_LOOSE_START, _LOOSE_END = re.compile("[%+]"), re.compile("[.%+]")
_AT = re.compile(r"\s?(?:\(at\)|\[at\]|\bat\b)\s?", re.IGNORECASE)
_SPELT_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\s?(?:\(dot\)|\[dot\]|\bdot\b|\.)\s?[A-Za-z0-9-]+)+", re.IGNORECASE)
#: Strings that may be credentials: what is assigned to a word for one, and long runs of letters and digits.
_CREDENTIAL = "token|secret|password|passwd|pwd|api[_-]?key|access[_-]?key|private[_-]?key|credential|auth"
_ASSIGNED = re.compile(rf"(?:{_CREDENTIAL})[\x20\t]?(?:=|:|=>)[\x20\t]?[\"']?([^\s\"',;]{{6,}})", re.IGNORECASE)
_CODE = re.compile("[A-Za-z0-9_+/-]{16,}={0,2}")
_LEADS = re.compile(rf"(?:{_CREDENTIAL})[\x20\t]?(?:=|:|=>)[\x20\t]?[\"']?$", re.IGNORECASE)
_HEX = re.compile("[0-9a-fA-F]+")
_TURN = re.compile("[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])")
_ASSIGNMENT = re.compile("[=:]")
_QUAD = re.compile(r"(?<![0-9])[0-9]{1,3}(?:\s?(?:\[\.\]|\(\.\)|\[dot\]|\(dot\))\s?[0-9]{1,3}){3}(?![0-9])", re.IGNORECASE)
#: Digits of a looser match of one number, and shapes of numbers in rows of digit groups; shapes of 13 digits or more are cards.
LEAST, MOST = 7, 19
SHAPES = ((4, 4, 4, 4), (4, 6, 5), (1, 3, 3, 4), (3, 3, 4), (2, 2, 2, 2, 2))
#: Words before a candidate that tell what it is.
CUES = {
    "phone": ("phone", "tel", "call", "fax", "mobile", "cell", "whatsapp", "sms"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "debit", "pan"),
    "email": ("mail", "e-mail", "email", "contact", "write"),
    "ip": ("ip", "host", "server", "address", "node"),
    "secret": ("token", "secret", "password", "passwd", "pwd", "key", "credential", "bearer", "auth"),
    "none": ("order", "invoice", "ref", "id", "no", "isbn", "version", "serial", "case", "commit", "sha", "checksum", "hash", "digest"),
}


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(x: str) -> str:
    return "".join(c for c in x if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """The base spans by kind and start; each pattern is scanned in time linear in the text."""
    out: list[Span] = []
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append(("email", start, found.end()))
            last = found.end()
        at = text.find("@", last if found else at + 1)
    if not _DIGIT.search(text):
        return out
    for chain in _DOTTED.finditer(text):
        if chain[0].count(".") < 3:
            continue
        parts, place = chain[0].split("."), chain.start()
        for k in range(0, len(parts) - 3, 4):  # the leftmost matches in a chain take four parts each
            end = place + sum(map(len, parts[k : k + 4])) + 3
            if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in parts[k : k + 4]):
                out.append(("ip", place, end))
            place = end + 1
    for m in _CARD.finditer(text):
        digits = _digits(m[0]) if len(m[0]) <= 40 else ""
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (ALL_KINDS.index(s[0]), s[1], s[2])))


# ---------------------------------------------------------------- nodes and edges


def _key(kind: str, text: str) -> str:
    """What equal or similar contents share: the last eight digits, or a mail address with signs for words."""
    if kind == "spelt":
        plain = re.sub(r"\s?[(\[]?\bat\b[)\]]?\s?", "@", text.lower())
        plain = re.sub(r"\s?[(\[]?\bdot\b[)\]]?\s?", ".", plain)
        return "m" + plain.replace(" ", "")
    if kind == "name":
        return "n" + text.lower()
    if kind == "secret":
        return "s" + text
    digits = _digits(text)
    return "d" + (digits[-8:] if kind == "groups" else ".".join(re.findall("[0-9]+", text)))


def _mentions(text: str, names: set[str]) -> Iterator[tuple[int, int]]:
    """Places of the names, the longest from each place, that no letters, digits, - or @ touch, nor a dot before them.

    Runs of a name's signs are looked up in the set, whatever its size: from each place where a name may start, up to
    each place where one may end that is as far as some name is long.
    """
    lengths = {len(x) for x in names}
    most = max(lengths)
    for run in _RUN.finditer(text):
        first, end = run.span()
        if end - first < min(lengths):
            continue
        after = end < len(text) and _TOUCHES.match(text[end])
        starts = [] if first and _TOUCHES.match(text[first - 1]) else [first]
        starts += [m.end() for m in _LOOSE_START.finditer(text, first, end)]
        ends = [m.start() for m in _LOOSE_END.finditer(text, first, end)] + ([] if after else [end])
        at = first
        for a in starts:
            if a < at:
                continue
            k = bisect.bisect_right(ends, a + most)
            while k and ends[k - 1] > a:
                k -= 1
                if ends[k] - a in lengths and text[a : ends[k]].lower() in names:
                    yield a, ends[k]
                    at = ends[k]
                    break


def _spelt(text: str) -> Iterator[tuple[int, int]]:
    """Written-out mail addresses: from each word for @ to the left as far as a name goes, to the right over all parts."""
    last = 0
    for at in _AT.finditer(text):
        start = at.start()
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        domain = _SPELT_DOMAIN.match(text, at.end()) if start < at.start() else None
        if domain and re.search(r"\bdot\b|[(\[]at[)\]]", at[0] + domain[0], re.IGNORECASE):
            last = domain.end()
            yield start, last


def _mixed(x: str) -> bool:
    """Whether a code has letters and digits, several times next to each other, as random ones have and words have not."""
    return len(_TURN.findall(x)) >= 3


def candidates(text: str, base: list[Span]) -> list[tuple[int, int, str, str, str]]:
    """(start, end, base kind or "", form, key) in the order of the text; looser matches don't overlap base spans."""
    out = [(a, b, kind, form := {"email": "spelt", "ip": "quad"}.get(kind, "groups"), _key(form, text[a:b])) for kind, a, b in base]
    taken = sorted((a, b) for a, b, *_ in out)
    out.sort()
    out = [x for i, x in enumerate(out) if not i or x[:2] != out[i - 1][:2]]
    ends = np.array([b for _, b in taken], np.int64)
    starts = np.array([a for a, _ in taken], np.int64)

    def free(a: int, b: int) -> bool:
        return not len(starts) or np.searchsorted(ends, a, "right") == np.searchsorted(starts, b, "left")

    low = text.lower()
    loose: list[tuple[int, int, str]] = []
    if _DIGIT.search(text):
        loose += [(m.start() + a, m.start() + b, "groups") for m in _GROUPS.finditer(text) for a, b in _numbers(m[0])]
        if "[.]" in text or "(.)" in text or "dot" in low:
            loose += [(*m.span(), "quad") for m in _QUAD.finditer(text)]
    if "(at)" in low or "[at]" in low or ("dot" in low and " at " in low):
        loose += [(a, b, "spelt") for a, b in _spelt(text)]
    names = {text[a:b].partition("@")[0].lower() for kind, a, b in base if kind == "email"}
    names = {x for x in names if len(x) >= 6 and re.search("[0-9._-]", x)}
    if names:
        loose += [(a, b, "name") for a, b in _mentions(text, names)]
    if _DIGIT.search(text):
        loose += [(*m.span(), "secret") for m in _CODE.finditer(text) if _mixed(m[0])]
    assigned = {m.span(1) for m in _ASSIGNED.finditer(text)} if _ASSIGNMENT.search(text) else set()
    loose += [(a, b, "secret") for a, b in assigned]
    last = -1
    # of matches from one place the longest, so that what is assigned is not cut
    for a, b, form in sorted(loose, key=lambda x: (x[0], -x[1], x[2])):
        if a >= last and free(a, b):
            # a code that is assigned to a word for a credential is one, as base spans are what they are
            sure = "secret" if (a, b) in assigned and _mixed(text[a:b]) else ""
            out.append((a, b, sure, form, _key(form, text[a:b])))
            last = b
    return sorted(out)


def _count(x: str) -> int:
    return len(_digits(x))


def _numbers(x: str) -> Iterator[tuple[int, int]]:
    """The places of single numbers in a match of _GROUPS.

    A match is one number if it has MOST digits or fewer, unless commas cut it into whole numbers and it is no card. Longer
    ones are cut at commas with a space, then at all commas and slashes between whole numbers, then at spaces beside whole
    numbers or before + and (, and what is left in cards and numbers of the usual shapes. Parts under LEAST digits are
    no candidates, as for _GROUPS; others are given whole, however long.
    """
    digits = _digits(x)
    listed = [m.span() for m in re.finditer(r"(?:[^,]|,(?![\x20]))+", x)]
    if len(digits) <= MOST:
        whole = len(listed) < 2 or (len(digits) >= 13 and luhn(digits)) or any(_count(x[a:b]) < LEAST for a, b in listed)
        yield from [(0, len(x))] if whole else (_trimmed(x, a, b) for a, b in listed)
        return
    for a, b in listed:
        parts = [(a, b)]
        for sign in ",/":
            parts = [q for p in parts for q in _cut(x, *p, sign)]
        for c, d in parts:
            for e, f in [(c, d)] if _count(x[c:d]) <= MOST else _worded(x, c, d):
                if _count(x[e:f]) >= LEAST:
                    yield _trimmed(x, e, f)


def _trimmed(x: str, a: int, b: int) -> tuple[int, int]:
    """The span without signs at its ends that belong to no number."""
    while x[a] not in "+(0123456789":
        a += 1
    while x[b - 1] not in "0123456789":
        b -= 1
    return a, b


def _cut(x: str, a: int, b: int, sign: str) -> list[tuple[int, int]]:
    """The span cut at a sign, if it is too long for one number and whole numbers stand between the signs."""
    if _count(x[a:b]) <= MOST or sign not in x[a:b]:
        return [(a, b)]
    parts = [(m.start() + a, m.end() + a) for m in re.finditer(f"[^{sign}]+", x[a:b])]
    return parts if all(_count(x[c:d]) >= LEAST or not _count(x[c:d]) for c, d in parts) else [(a, b)]


def _worded(x: str, a: int, b: int) -> Iterator[tuple[int, int]]:
    """The span cut at spaces: a number ends beside a whole one and before + or (; rows of short groups give usual shapes."""
    words = [(m.start() + a, m.end() + a, _count(m[0])) for m in re.finditer(r"[^\x20]+", x[a:b])]
    words = [w for w in words if w[2]]
    runs: list[list[tuple[int, int, int]]] = []
    many = 0
    for w in words:
        if runs and not (many >= LEAST and (x[w[0]] in "+(" or w[2] >= LEAST or runs[-1][-1][2] >= LEAST)):
            runs[-1].append(w)
            many += w[2]
        else:
            runs.append([w])
            many = w[2]
    for run in runs:
        if sum(w[2] for w in run) <= MOST:
            yield run[0][0], run[-1][1]
            continue
        k = 0
        while k < len(run):
            n = 1
            for shape in SHAPES:
                if tuple(w[2] for w in run[k : k + len(shape)]) == shape and (sum(shape) < 13 or luhn(_digits(x[run[k][0] : run[k + len(shape) - 1][1]]))):
                    n = len(shape)
                    break
            yield run[k][0], run[k + n - 1][1]
            k += n


#: Places of features: the words before a node, and what tells of a credential.
CUE, SECRET = 22, 28
#: What a known label weighs, in nats.
KNOWN = 30.0
FEATURES = 33


def node_features(text: str, node: tuple[int, int, str, str, str]) -> np.ndarray:
    a, b, kind, form, _ = node
    x, out = text[a:b], np.zeros(FEATURES)
    n = len(_digits(x))
    out[0] = 1
    if kind in KINDS:
        out[1 + KINDS.index(kind)] = 1
    else:
        if form == "secret":
            out[SECRET] = 1
            out[SECRET + 1] = a > 0 and text[a - 1] in "\"'"
            out[SECRET + 2] = bool(_LEADS.search(text, max(0, a - 24), a))
            out[SECRET + 3], out[SECRET + 4] = bool(_HEX.fullmatch(x)), _mixed(x)
        else:
            out[5 + ("groups", "quad", "spelt", "name").index(form)] = 1
        if form == "groups":
            out[9 + int(np.searchsorted([9, 10, 11, 13, 16, 17, 20], n, "right"))] = 1
            out[17] = 13 <= n <= 19 and luhn(_digits(x))
            out[18], out[19], out[20] = x[0] == "+", "(" in x, len(re.findall("[0-9]{4}(?:[ -]|$)", x)) >= 3
            out[21] = bool(re.search(r"[ ().-]", x))
    before = text[max(0, a - 24) : a].lower()
    words = set(re.findall("[a-z-]+", before)[-3:])
    for k, cues in enumerate(CUES.values()):
        out[CUE + k] = not words.isdisjoint(cues)
    return out


def edges(nodes: list[tuple[int, int, str, str, str]], features: np.ndarray) -> list[tuple[int, int, int]]:
    """(i, j, kind): 0 for neighbours in the text; 1 for a key's hub and a node with that key, 2 if only the hub is heard.

    A key's hub is its first base span, else its first node after a cue, else its first node, so evidence reaches all
    mentions in two steps, and there are fewer edges than twice the nodes. The hub hears mentions that have evidence
    of their own (base form, cue, or a neighbour with one), and one of the others: a hundred mentions that tell nothing
    do not outvote the one that does.
    """
    told = np.array([bool(x[2]) for x in nodes]) | features[:, CUE : CUE + len(CUES)].any(1)
    near = [(j - 1, j) for j in range(1, len(nodes)) if nodes[j][0] - nodes[j - 1][1] <= NEAR]
    loud = told.copy()
    for i, j in near:
        if nodes[i][4] != nodes[j][4]:
            loud[i] |= told[j]
            loud[j] |= told[i]
    out = [(i, j, 0) for i, j in near]
    groups: dict[str, list[int]] = {}
    mails: dict[str, list[int]] = {}
    for j, (*_, key) in enumerate(nodes):
        groups.setdefault(key, []).append(j)
        if key.startswith("m"):  # a mail address is similar to its own name
            mails.setdefault("n" + key[1:].partition("@")[0], []).append(j)
    for key, members in groups.items():
        hub = min([*members, *mails.get(key, [])], key=lambda j: (not nodes[j][2], not told[j], j))
        heard = False
        for j in members:
            if j != hub:
                out.append((hub, j, 1 if loud[j] or not heard else 2))
                heard |= not loud[j]
    return out


class Field:
    """unary: features by labels; pair: for chain and skip edges, labels by labels, symmetric."""

    def __init__(self, unary: np.ndarray, pair: np.ndarray):
        self.unary, self.pair = unary, pair

    def labels(self, features: np.ndarray, links: np.ndarray) -> np.ndarray:
        """Each node's label probabilities when the messages along links (i, j, kind) have settled.

        There are as many rounds as nodes at most: by then a message has crossed any path.
        """
        own = features @ self.unary
        for k in range(len(KINDS)):  # base spans and assigned credentials are what they are
            own[features[:, 1 + k] > 0, 1 + k] += KNOWN
        own[(features[:, SECRET + 2] > 0) & (features[:, SECRET + 4] > 0), LABELS.index("secret")] += KNOWN
        if len(links):
            i, j, kind = np.concatenate([links, links[:, [1, 0, 2]]]).T  # both ways
            back = np.concatenate([np.arange(len(links)) + len(links), np.arange(len(links))])
            heard = (kind < 2) | (np.arange(len(i)) < len(links))
            pair = self.pair[np.minimum(kind, 1)]
            message = np.zeros((len(i), len(LABELS)))
            for step in range(max(DAMPED, len(own))):
                belief = own.copy()
                np.add.at(belief, j, message)
                out = (belief[i] - message[back])[:, :, None] + pair
                top = out.max(1)
                new = top + np.log(np.exp(out - top[:, None]).sum(1))
                new -= new.max(1, keepdims=True)
                new[~heard] = 0
                change = np.abs(new - message).max()
                message = new if step < DAMPED else (new + message) / 2
                if change <= SETTLED:
                    break
            own = own.copy()
            np.add.at(own, j, message)
        p = np.exp(own - own.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)


# ---------------------------------------------------------------- training


def _example(rng: random.Random) -> tuple[str, list[tuple[int, int, str]]]:
    """A made-up text and its true spans (start, end, label): each entity is mentioned in a proper and in looser forms."""
    words = "the of and with from near under about when paper river stone green early market".split()
    pieces: list[tuple[str, str]] = []

    def filler(n: int) -> None:
        pieces.append((" ".join(rng.choice(words) for _ in range(n)), "none"))

    def number(n: int) -> str:
        return str(rng.randrange(1, 10)) + "".join(str(rng.randrange(10)) for _ in range(n - 1))

    for _ in range(rng.randrange(1, 5)):
        filler(rng.randrange(3, 20))
        kind, name = rng.choice([*LABELS, "none"]), ""
        if kind == "phone":
            x = number(10)
            proper, loose = f"+1 ({x[:3]}) {x[3:6]}-{x[6:]}", [f"({x[:3]}) {x[3:6]}-{x[6:]}", f"{x[:3]}-{x[3:6]}-{x[6:]}", f"{x[:3]}.{x[3:6]}.{x[6:]}", f"1{x}"]
        elif kind == "card":
            x = number(15)
            x += next(d for d in "0123456789" if luhn(x + d))
            proper, loose = x, [f"{x[:4]} {x[4:8]}, {x[8:12]} {x[12:]}", f"{x[:4]}/{x[4:8]}/{x[8:12]}/{x[12:]}", f"{x[:4]}.{x[4:8]}.{x[8:12]}.{x[12:]}"]
        elif kind == "ip":
            x = [str(rng.randrange(256)) for _ in range(4)]
            proper, loose = ".".join(x), ["[.]".join(x), "(.)".join(x)]
        elif kind == "email":
            name = rng.choice(words) + rng.choice("._-") + number(2)
            host, end = rng.choice(words), rng.choice(["com", "org", "net"])
            proper, loose = f"{name}@{host}.{end}", [f"{name} (at) {host}.{end}", f"{name} [at] {host} [dot] {end}", f"{name} at {host} dot {end}", name]
        elif kind == "secret":
            x = "".join(rng.choice(signs) for signs in [rng.choice(["0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"])] for _ in range(rng.choice([20, 24, 32, 40, 64])))
            word = rng.choice(["token", "secret", "password", "api_key", "access-key", "pwd"])
            proper, loose = rng.choice([f'{word} = "{x}"', f"{word}={x}", f"{word}: {x}", f"{word} = '{x}'"]), [x, f'"{x}"']
        elif rng.random() < 0.3:
            x = "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice([32, 40, 64])))
            proper, loose = rng.choice([x, f'"{x}"', f"sha256:{x}", f'commit = "{x}"']), [x]
        else:
            x = number(rng.choice([7, 8, 9, 10, 10, 10, 11, 11, 11, 12, 14, 16, 18, 22]))
            proper, loose = x, [x, f"{x[:4]}-{x[4:]}", f"{x[:3]}/{x[3:]}"]
        forms = [proper] * (rng.random() < 0.7 or kind == "none") + [rng.choice(loose) for _ in range(rng.randrange(0, 3))]
        rng.shuffle(forms)
        told = rng.random() < 0.5
        for form in forms:
            if told:
                pieces.append((rng.choice(CUES[kind]), "none"))
            elif (form == name or kind == "secret") and proper not in forms:
                continue  # nothing tells that it is an address or a credential
            pieces.append((form, kind))
            filler(rng.randrange(2, 12))
    text, spans = "", []
    for x, kind in pieces:
        text += " " if text else ""
        if kind != "none":
            spans.append((len(text), len(text) + len(x), kind))
        text += x
    return text, spans


def examples(n: int, seed: int) -> Iterator[tuple[str, list, list[tuple[int, int, int]], np.ndarray]]:
    """Made-up texts with their nodes, edges and true labels."""
    rng = random.Random(seed)
    for _ in range(n):
        text, spans = _example(rng)
        nodes = candidates(text, base_spans(text))
        if nodes:
            # base spans stay, so each is what its pattern says
            truth = [LABELS.index(node[2]) if node[2] else next((LABELS.index(k) for a, b, k in spans if a < node[1] and node[0] < b), 0) for node in nodes]
            yield text, nodes, edges(nodes, np.array([node_features(text, x) for x in nodes])), np.array(truth)


@functools.cache
def train(n: int = 2000, seed: int = 7, steps: int = 300) -> Field:
    """A field fitted to made-up texts by pseudo-likelihood: each label given its features and its neighbours' true labels."""
    rows, around, truth = [], [], []
    for text, nodes, links, labels in examples(n, seed):
        beside = np.zeros((len(nodes), 2, len(LABELS)))
        for i, j, kind in links:
            beside[j, min(kind, 1), labels[i]] += 1
            if kind < 2:
                beside[i, kind, labels[j]] += 1
        rows += [node_features(text, x) for x in nodes]
        around.append(beside)
        truth.append(labels)
    x, y = np.array(rows), np.concatenate(truth)
    beside = np.concatenate(around)
    unary, pair = np.zeros((FEATURES, len(LABELS))), np.zeros((2, len(LABELS), len(LABELS)))
    goal = np.eye(len(LABELS))[y]
    rate, keep = 1.0, 0.9
    moves = [np.zeros_like(unary), np.zeros_like(pair)]
    for _ in range(steps):
        score = x @ unary + np.einsum("nkl,klm->nm", beside, pair)
        p = np.exp(score - score.max(1, keepdims=True))
        gap = (p / p.sum(1, keepdims=True) - goal) / len(y)
        step = np.einsum("nkl,nm->klm", beside, gap) + 2e-5 * pair
        moves[0] = keep * moves[0] - rate * (x.T @ gap + 2e-5 * unary)
        moves[1] = keep * moves[1] - rate * (step + step.transpose(0, 2, 1)) / 2
        unary += moves[0]
        pair += moves[1]
    return Field(unary, pair)


# ---------------------------------------------------------------- spans of documents


def find(texts: list[str], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each text; the fields of all texts are solved together."""
    out: list[tuple[list[Span], list[Span]]] = []
    rows, links, owners, first = [], [], [], 0
    for k, text in enumerate(texts):
        base = base_spans(text)
        out.append((base, list(base)))
        nodes = candidates(text, base)
        out[-1][1].extend(("secret", a, b) for a, b, kind, *_ in nodes if kind == "secret")
        if len(nodes) > sum(1 for x in nodes if x[2]):  # there is something to decide
            own = [node_features(text, x) for x in nodes]
            rows += own
            links += [(i + first, j + first, kind) for i, j, kind in edges(nodes, np.array(own))]
            owners += [(k, x) for x in nodes]
            first += len(nodes)
    if rows:
        p = field.labels(np.array(rows), np.array(links, np.int64).reshape(-1, 3))
        best = p.argmax(1)
        for (k, (a, b, kind, _, _)), label, sure in zip(owners, best.tolist(), p.max(1).tolist(), strict=True):
            if not kind and label and sure >= SURE:
                out[k][1].append((LABELS[label], a, b))
    return out


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans for each row of docs.

    The counts and the digest are of base spans, spans holds all as kind:start:end, with secrets, which only the field
    finds, after the four kinds of base spans. Null texts are empty: no spans, and the digest of nothing. Texts are read
    whole, in time linear in their length. Repeated rows get equal results. An empty table gives no rows. Other columns aren't read.
    """
    bounded_batches(docs.sparkSession)
    field = docs.sparkSession.sparkContext.broadcast(train())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = find([x or "" for x in batch.column(1).to_pylist()], field.value)
            counts = [pa.array([sum(s[0] == kind for s in base) for base, _ in found], pa.int64()) for kind in KINDS]
            sums = pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, sums, pa.array([joined(all_) for _, all_ in found], pa.string())], ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    picked = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = StructType([picked.schema["doc_id"]])
    for k in KINDS:
        kind = kind.add(f"n_{k}", "long")
    return picked.mapInArrow(run, kind.add("base_sha256", "string").add("spans", "string"))


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans become one, named by the first."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """docs with personal data replaced in its texts, all columns as they were; n_chars, if there, is counted again. Null texts stay null."""
    bounded_batches(docs.sparkSession)
    field = docs.sparkSession.sparkContext.broadcast(train())
    at = docs.columns.index(text)
    schema = to_arrow_schema(docs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            found = find([x or "" for x in texts], field.value)
            new = [None if x is None else redacted(x, all_) for x, (_, all_) in zip(texts, found, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(new, schema.field(at).type) if k == at else c for k, c in enumerate(batch.columns)], schema=schema)

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn(n_chars, F.length(text).cast(docs.schema[n_chars].dataType)) if n_chars in docs.columns else out

"""Token counts by a compiled finite-state tokenizer.

A BPE vocabulary with word ends is compiled, as texts need it, into one
deterministic transducer over characters. A state holds the pre-tokenizer's
mode and what of the current word can still take part in a token; a transition
carries the next state and the number of tokens emitted. Merging needs no
search at run time: a sequence of tokens is what BPE gives if and only if BPE
leaves each adjacent pair as it is, so the last token of every prefix of a word
follows from the last tokens of shorter prefixes, and only prefixes within the
longest open vocabulary prefix matter. Counts are kept relative to the state,
so a transition may emit a negative number when a longer token swallows
earlier ones.

Long texts are cut into chunks. White space brings every state to the start
state, so the state map of a chunk is: what stands before its first white space
(whose count depends on the entry state), the count of the rest and the exit
state. Maps compose associatively and are folded by a parallel prefix scan.
"""

from __future__ import annotations

import json
import re
import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import table

#: States kept before the compiled part is dropped and compiled anew; bounds a worker's memory.
MOST_STATES = 300_000
CHUNK = 1 << 15


class State(dict):
    """Transitions by character: (next state, emitted tokens). Missing ones are compiled on first use."""

    __slots__ = ("owner", "mode", "word")

    def __init__(self, owner, mode, word):
        self.owner, self.mode, self.word = owner, mode, word

    def __missing__(self, ch):
        self[ch] = out = self.owner.compiled(self, ch)
        return out


class Transducer:
    """Compiled form of a tokenizer file of the `tokenizers` library: BPE with word ends, lower case, byte level."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or not model.get("end_of_word_suffix"):
            raise ValueError("a BPE model with an end-of-word suffix is expected")
        self.suffix = model["end_of_word_suffix"]
        lib = Tokenizer.from_file(path)
        self.normalizer, self.splitter = lib.normalizer, lib.pre_tokenizer
        self.special = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"])) if spec["added_tokens"] else None
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.ranks = {m: i for i, m in enumerate(merges)}
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.symbol = {}
        for b in range(256):  # the byte-level alphabet, from the library: 2-byte text carries each high byte
            ch = chr(b) if b < 128 else None
            if ch is not None:
                self.symbol[b] = level.pre_tokenize_str(ch)[0][0]
        for lead in range(0xC2, 0xF5):
            tail = {0xE0: b"\xa0\x80", 0xF0: b"\x90\x80\x80"}.get(lead, b"\x80" if lead < 0xE0 else b"\x80\x80" if lead < 0xF0 else b"\x80\x80\x80")
            self.symbol[lead] = level.pre_tokenize_str((bytes([lead]) + tail).decode())[0][0][0]
        for b in range(0x80, 0xC0):
            self.symbol[b] = level.pre_tokenize_str(bytes([0xC3, b]).decode())[0][0][1]
        #: token string without the word end -> (is a token inside words, is a token at word ends)
        self.mid, self.end, self.prefixes = set(), set(), {""}
        for t in model["vocab"]:
            if self.special and self.special.fullmatch(t):
                continue
            plain = t.removesuffix(self.suffix)
            (self.end if plain != t else self.mid).add(plain)
            for k in range(1, len(plain) + 1):
                self.prefixes.add(plain[:k])
        self.pairs: dict[tuple[str, str, bool], bool] = {}
        self.kinds: dict[str, str] = {}
        self.reset()

    def reset(self):
        self.states: dict[tuple, State] = {}
        self.pairs.clear()
        self.start = self.state("start", ("", ()))

    def state(self, mode, word) -> State:
        key = (mode, word)
        if key not in self.states:
            self.states[key] = State(self, mode, word)
        return self.states[key]

    # BPE on a few symbols, for the compiler only.
    def merged(self, symbols: list[str]) -> list[str]:
        while len(symbols) > 1:
            rank, at = min((self.ranks.get((symbols[i], symbols[i + 1]), 1 << 30), i) for i in range(len(symbols) - 1))
            if rank == 1 << 30:
                break
            symbols = [*symbols[:at], symbols[at] + symbols[at + 1], *symbols[at + 2 :]]
        return symbols

    def stays(self, left: str, right: str, ends: bool) -> bool:
        """Whether BPE leaves the two tokens as they are; left '' asks for the right one alone."""
        key = (left, right, ends)
        if key not in self.pairs:
            symbols = list(left + right)
            token = right
            if ends:
                symbols[-1] += self.suffix
                token += self.suffix
            self.pairs[key] = self.merged(symbols) == ([left, token] if left else [token])
        return self.pairs[key]

    # A word in progress: (open, lasts). open: its longest suffix that starts a vocabulary item; lasts: for each
    # place from the start of `open` to here, the last token of the prefix up to there and the tokens since.
    def grown(self, word, symbol):
        """The word with one more symbol inside, and the change of its token count."""
        open_, lasts = word
        lasts = lasts or (("", 0),)
        text = open_ + symbol
        for k in range(len(text)):  # longest token first
            token = text[k:]
            if token in self.mid and self.stays(lasts[k][0], token, False):
                emitted = lasts[k][1] + 1
                break
        else:
            raise ValueError(f"no token for {text!r}")
        places = [*((t, n - emitted) for t, n in lasts), (token, 0)]
        while text not in self.prefixes:
            text = text[1:]
            places = places[1:]
        return (text, tuple(places[-len(text) - 1 :])), emitted

    def ended(self, word) -> int:
        """Change of the count when the word ends here."""
        open_, lasts = word
        if not lasts:
            return 0
        for k in range(len(open_)):
            if open_[k:] in self.end and self.stays(lasts[k][0], open_[k:], True):
                return lasts[k][1] + 1
        raise ValueError(f"no end token for {open_!r}")

    def spelled(self, text: str) -> tuple[tuple, int]:
        word, n = ("", ()), 0
        for b in text.encode():
            word, m = self.grown(word, self.symbol[b])
            n += m
        return word, n

    def whole(self, text: str) -> int:
        word, n = self.spelled(text)
        return n + self.ended(word)

    def kind(self, ch: str) -> str:
        """letter, number, space or other, as the library's pre-tokenizer takes the character."""
        if ch not in self.kinds:
            pieces = lambda t: len(self.splitter.pre_tokenize_str(t))
            self.kinds[ch] = "space" if not pieces(ch) else "letter" if pieces("a" + ch) == 1 else "other" if pieces("!" + ch) == 1 else "number"
        return self.kinds[ch]

    def compiled(self, state: State, raw: str):
        """The transition of a state on one character as it stands in the text."""
        if len(self.states) > MOST_STATES:
            self.full = True
        n = 0
        for ch in self.normalizer.normalize_str(raw):
            state, m = self.step(state, ch)
            n += m
        return state, n

    full = False
    #: What may follow an apostrophe at the start of a piece: complete at once, or after one more letter.
    SHORT, LONG = frozenset("stmd"), {"r": "e", "v": "e", "l": "l"}

    def step(self, state: State, ch: str):
        kind, mode, word = self.kind(ch), state.mode, state.word
        if mode == "quote":  # an apostrophe stands at the start of a piece
            if ch in self.SHORT:
                return self.start, self.whole("'" + ch)
            if ch in self.LONG:
                return self.state("quote" + ch, ("", ())), 0
            mode, word, n = "other", *self.spelled("'")
        elif mode.startswith("quote"):
            if ch == self.LONG[mode[-1]]:
                return self.start, self.whole("'" + mode[-1] + ch)
            before = self.whole("'")
            mode, word, n = "letter", *self.spelled(mode[-1])
            n += before
        else:
            n = 0
        if kind != mode or kind == "number":
            n += self.ended(word)
            if kind == "space":
                return self.start, n
            if ch == "'":
                return self.state("quote", ("", ())), n
            word = ("", ())
        if kind == "number":
            return self.start, n + self.whole(ch)
        for b in ch.encode():
            word, m = self.grown(word, self.symbol[b])
            n += m
        return self.state(kind, word), n

    def final(self, state: State) -> int:
        """Tokens still to be emitted if the text ends here."""
        if state.mode == "quote":
            return self.whole("'")
        if state.mode.startswith("quote"):
            return self.whole("'") + self.whole(state.mode[-1])
        return self.ended(state.word)

    @staticmethod
    def run(state: State, text: str):
        n = 0
        for ch in text:
            state, m = state[ch]
            n += m
        return state, n

    SPACE = re.compile(r"[ \n\t]")

    def chunk_map(self, text: str):
        """(head, count, exit): head leads any entry state to the start state; exit None: no white space, all is head."""
        at = self.SPACE.search(text)
        if not at:
            return text, 0, None
        exit_, n = self.run(self.start, text[at.end() :])
        return text[: at.end()], n, exit_

    def composed(self, a, b):
        """The map of a chunk followed by that of the next."""
        if a[2] is None:
            return a[0] + b[0], b[1], b[2]
        state, n = self.run(a[2], b[0])
        return (a[0], a[1] + n, state) if b[2] is None else (a[0], a[1] + n + b[1], b[2])

    def scanned(self, maps: list):
        """Parallel prefix scan, up-sweep only: the last prefix is the map of the whole text."""
        while len(maps) > 1:
            maps = [self.composed(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return maps[0]

    def piece(self, text: str) -> int:
        if not text:
            return 0
        if not text.isascii() and not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        head, n, exit_ = self.scanned([self.chunk_map(text[i : i + CHUNK]) for i in range(0, len(text), CHUNK)])
        state, m = self.run(self.start, head)
        if exit_ is None:
            return m + self.final(state)
        return n + m + self.final(exit_)

    def count(self, text: str | None) -> int:
        """Tokens of a text as the library gives them without added special tokens."""
        if not text:
            return 0
        if self.full:
            self.reset()
            self.full = False
        if self.special is None or "<|" not in text:
            return self.piece(text)
        return sum(map(self.piece, self.special.split(text))) + len(self.special.findall(text))


_compiled: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """One compiled transducer per worker and file."""
    if path not in _compiled:
        _compiled[path] = Transducer(path)
    return _compiled[path]


def token_counts(docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    Null and empty texts count 0 bytes and 0 tokens; null ids and repeated rows stay, one row each; other columns are
    not read. An empty table gives no rows. `path`: the tokenizer file, readable on every executor.
    """

    def counted(batches):
        import pyarrow as pa

        machine = transducer(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([machine.count(t) for t in b.column(2).to_pylist()], pa.int64())], names=["id", "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    out = rows.mapInArrow(counted, f"id {kind}, n_bytes long, n_tokens long")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))

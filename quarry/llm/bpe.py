"""BPE encoding by a bounded-lookahead streaming transducer, and decoding by an incremental state machine.

The transducer reads a pre-token's symbols from the left. For every prefix it keeps the last token of that
prefix's encoding: the longest token that ends there and that may follow the encoding before it, which the
merge list decides pair by pair. What later symbols can add starts within the longest token's length of the
end, so tokens that all those prefixes share are stable: they are emitted and dropped. What is kept is below
`lookahead`, the number of merges times the longest token, a bound that the merge list alone fixes; in
practice a few dozen symbols are kept, whatever the length of the text.

A text is read in blocks that end before white space, where no pre-token and no composed character crosses;
each block is normalised and split, and its pre-tokens go through the transducer. The encodings of short pieces
are kept in a table of bounded size. The ids of a block go to the decoder, a machine whose state is a few bytes:
whether a token came before, and the bytes of a character that is not complete yet. So what is held besides the
text itself does not grow with it.

Defined cases. Null text counts as empty; empty text has no tokens and decodes to empty text. Strings of
special tokens in a text become those tokens, as in the library. Rows, ids and other columns pass unchanged;
an input column with the name of a result column is replaced.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import islice, takewhile

import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .shared import documents, map_arrow, worker_keeps

#: Entries of each table of pieces already encoded or decoded.
TABLE = 120_000
#: Symbols read between two searches for stable tokens, and pieces handled at once.
BLOCK = 256
PIECES = 8192
#: Characters of a text that are normalised and split at once, at least; a block ends before white space and an ASCII letter or digit.
TEXT_BLOCK = 1 << 16
CUT = re.compile("[\t-\r ](?=[0-9A-Za-z])")
#: Python counts U+001C to U+001F as white space; the tokenizer's pattern does not.
WHITE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
ODD = re.compile("[\x1c-\x1f]")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars, extra = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in chars:
            chars[b] = chr(extra)
            extra += 1
    return [chars[b] for b in range(256)]


class Bounded(dict):
    """A table filled by `make`. When it is full it is set aside, in the place of the one before, and entries still in use come back from there."""

    def __init__(self, make, most: int = TABLE):
        super().__init__()
        self.make, self.most, self.aside = make, most, {}

    def __missing__(self, key):
        if len(self) >= self.most:
            self.aside = None
            self.aside = dict(self)
            self.clear()
        value = self.aside.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value


class Transducer:
    """The merge list as a left-to-right encoder of symbol strings."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        self.suffix = suffix
        made = {a + b for a, b in merges}
        base = sorted((t for t in vocab if t not in made), key=vocab.get)
        order = [*base, *(a + b for a, b in merges if (a + b) in vocab)]
        number: dict[str, int] = {}
        for t in order:
            number.setdefault(t, len(number))
        self.number, self.out = number, [vocab[t] for t in number]
        self.base = len(base)
        self.split = [(k, k) for k in range(len(base))] + [(-1, -1)] * (len(number) - len(base))
        self.pair: dict[tuple[int, int], int] = {}
        for a, b in merges:
            t = number[a + b]
            if self.split[t][0] < 0:
                self.split[t] = (number[a], number[b])
            self.pair.setdefault((number[a], number[b]), t)
        self.inner, self.final = self._by_ending(False), self._by_ending(True) if suffix else None
        self.fits = Bounded(lambda ab: self.follows(ab >> 20, ab & 0xFFFFF), TABLE // 2)
        self.width = [len(self._symbols(t)) for t in number]
        self.longest = max(self.width, default=1)
        self.prefixes = Bounded(lambda prefix: self._ending(prefix, *self.inner), TABLE // 3)
        self.lookahead = max(1, len(merges)) * self.longest

    def _symbols(self, token: str) -> str:
        """A token's symbols, one character each; the suffix belongs to the last one."""
        return token[: -len(self.suffix)] if self.suffix and token.endswith(self.suffix) and token != self.suffix else token

    def _by_ending(self, final: bool) -> tuple[dict[str, int], dict[str, list[int]]]:
        """Tokens that stand inside a word, or at its end; and by the last three symbols the lengths there are, longest first."""
        tokens = {}
        for t, k in self.number.items():
            if bool(self.suffix and t.endswith(self.suffix) and t != self.suffix) == final and (k < self.base or self._proper(k)):
                tokens[self._symbols(t)] = k
        lengths: dict[str, set[int]] = {}
        for t in tokens:
            lengths.setdefault(t[-3:], {1, 2}).add(len(t))
        return tokens, {e: sorted(n, reverse=True) for e, n in lengths.items()}

    def _proper(self, k: int) -> bool:
        """Whether the merges of a token's own symbols lead to it."""
        a, b = self.split[k]
        return a >= 0 and self.pair[a, b] == k and self.follows(a, b, k)

    def follows(self, a: int, b: int, below: int | None = None) -> bool:
        """Whether the encoding of a's and b's text together is a, then b: no merge across their border comes before those that make them."""
        pair, split, base = self.pair, self.split, self.base
        limit = len(self.number) if below is None else below
        while True:
            across = pair.get((a, b))
            if across is not None and across < limit:
                return False
            if a > b or (a == b and a >= base):
                if a < base:
                    a_done = True
                else:
                    limit, a, a_done = min(limit, a), split[a][1], False
                if a_done:
                    if b < base:
                        return True
                    limit, b = min(limit, b + 1), split[b][0]
            else:
                if b >= base:
                    limit, b = min(limit, b + 1), split[b][0]
                elif a >= base:
                    limit, a = min(limit, a), split[a][1]
                else:
                    return True

    def _last(self, text: str, n: int, last: list[int | None], size: list[int], final: bool = False) -> int:
        """The token that ends the encoding of text[:n], put into `last` with its length; what it needs of shorter prefixes is found first."""
        tokens, lengths = self.final if final else self.inner
        fits = self.fits
        for w in lengths.get(text[n - 3 : n] if n > 3 else text[:n], (2, 1)):
            if w <= n:
                t = tokens.get(text[n - w : n])
                if t is not None:
                    before = last[n - w]
                    if before is None:
                        before = self._last(text, n - w, last, size)
                    if before < 0 or fits[before << 20 | t]:
                        break
        last[n], size[n] = t, w
        return t

    def stream(self, symbols: Iterable[str]) -> Iterator[int]:
        """Token ids of one pre-token, given as blocks of symbols, each emitted once stable."""
        text, last, size, pending = "", [-1], [0], ""
        for block in symbols:
            pending += block
            cut = len(pending) - 1 if self.suffix else len(pending)
            for at in range(0, cut, BLOCK):
                text += pending[at : min(cut, at + BLOCK)]
                while len(last) <= len(text):
                    last.append(None)
                    size.append(0)
                    self._last(text, len(last) - 1, last, size)
                border = self._stable(size)
                if border:
                    yield from self._path(last, size, border)
                    text, last, size = text[border:], last[border:], [0, *size[border + 1 :]]
                if len(text) > self.lookahead + 2 * BLOCK:
                    raise RuntimeError("more symbols are kept than the merge list's lookahead")
            pending = pending[cut:]
        if pending:
            text += pending
            last.append(None)
            size.append(0)
            self._last(text, len(text), last, size, True)
        yield from self._path(last, size, len(text))

    def _path(self, last: list[int], size: list[int], end: int) -> list[int]:
        found = []
        while end > 0:
            found.append(self.out[last[end]])
            end -= size[end]
        return found[::-1]

    def _stable(self, size: list[int]) -> int:
        """The last border that the encodings of all prefixes that later tokens can follow have in common."""
        end = len(size) - 1
        chains = list(range(max(0, end - self.longest), end + 1))
        while chains and chains[0] != chains[-1]:
            top = chains.pop()
            shorter = top - size[top]
            lo = [c for c in chains if c < shorter]
            chains = lo + [shorter] + [c for c in chains if c > shorter]
        return chains[0] if chains else 0

    def _ending(self, text: str, tokens: dict[str, int], lengths: dict[str, list[int]]) -> int:
        """The token that ends a short text's encoding. What it needs of shorter prefixes is kept in a table, since words share their beginnings."""
        n, fits, prefixes = len(text), self.fits, self.prefixes
        for w in lengths.get(text[-3:], (2, 1)):
            if w <= n:
                t = tokens.get(text[n - w :])
                if t is not None and (w == n or fits[prefixes[text[: n - w]] << 20 | t]):
                    return t
        return t

    def encode(self, symbols: str) -> list[int]:
        """Token ids of one short pre-token."""
        if len(symbols) > BLOCK:
            return list(self.stream([symbols]))
        if not symbols:
            return []
        t, end = self._ending(symbols, *(self.final if self.suffix else self.inner)), len(symbols)
        found = [self.out[t]]
        while end := end - self.width[t]:
            t = self.prefixes[symbols[:end]]
            found.append(self.out[t])
        return found[::-1]


class Codec:
    """A tokenizer file (JSON of the tokenizers library) with byte-level symbols and white space dropped."""

    def __init__(self, spec: str):
        t = json.loads(spec)
        model = t["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.transducer = Transducer(model["vocab"], merges, model.get("end_of_word_suffix") or "")
        self.special = {x["content"]: x["id"] for x in t["added_tokens"]}
        self.token = {i: x for x, i in (model["vocab"] | self.special).items()}
        self.letters = byte_alphabet()
        steps = (t["normalizer"] or {}).get("normalizers", [])
        self.nfc, self.lower = any(x["type"] == "NFC" for x in steps), any(x["type"] == "Lowercase" for x in steps)
        pre = next(x for x in t["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")
        if not (pre["invert"] and pre["behavior"] == "Removed"):
            raise ValueError("only tokenizers whose pre-tokens hold no white space are read")
        self.pattern = regex.compile(pre["pattern"]["Regex"])
        self.borders = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pieces = Bounded(self._piece)
        self.byte = {c: b for b, c in enumerate(self.letters)}
        self.spelled = {str(i): x.encode("utf-8", "replace") for i, x in self.token.items()}

    def _symbols(self, word: str) -> str:
        letters = self.letters
        return "".join([letters[b] for b in word.encode("utf-8", "replace")])

    def _word(self, word: str) -> str:
        """The ids of a pre-token in decimal."""
        return " ".join(map(str, self.transducer.encode(self._symbols(word))))

    def _piece(self, piece: str) -> str:
        """The same of what stands between white space: pre-tokens are pieces too and are looked up as such."""
        if piece.isalpha():  # letters alone are one pre-token
            return self._word(piece)
        if piece[-1] in ".," and piece[:-1].isalpha():
            found = [piece[:-1], piece[-1]]
        else:
            found = self.pattern.findall(piece)
            if len(found) == 1:
                return self._word(piece)
        return " ".join([self.pieces[w] for w in found])

    def _long(self, piece: str) -> Iterator[list[str]]:
        """Blocks of ids of a long piece: its pre-tokens one by one, the long ones as a stream of symbols."""
        for m in self.pattern.finditer(piece):
            begin, end = m.span()
            if end - begin <= BLOCK:
                yield [self.pieces[m[0]]]
                continue
            ids = self.transducer.stream(self._symbols(piece[k : min(k + BLOCK, end)]) for k in range(begin, end, BLOCK))
            while block := list(islice(ids, PIECES)):
                yield [" ".join(map(str, block))]

    def normalise(self, text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text) if self.nfc else text
            text = text.replace("Σ", "σ")  # characters are lowered one by one: no final form
        return text.lower() if self.lower else text

    def _spans(self, text: str) -> Iterator[tuple[int, int, bool]]:
        """Begin and end of blocks of the text, and whether a block is a special token."""
        at, special = 0, iter(())
        if self.borders and any(s in text for s in self.special):
            special = self.borders.finditer(text)
        for m in [*special, None] if text else ():
            end = m.start() if m else len(text)
            while at < end:
                cut = CUT.search(text, min(at + TEXT_BLOCK, end), end)
                upto = cut.start() if cut else end
                yield at, upto, False
                at = upto
            if m:
                yield m.start(), m.end(), True
                at = m.end()

    def encode_pieces(self, text: str | None) -> Iterator[list[str]]:
        """Token ids in decimal, those of a piece joined by one space; in blocks of pieces."""
        for begin, end, special in self._spans(text or ""):
            part = text[begin:end]
            if special:
                yield [str(self.special[part])]
                continue
            part = self.normalise(part)
            pieces = part.split() if not ODD.search(part) else [x for x in WHITE.split(part) if x]
            at = 0
            while at < len(pieces):
                short = pieces[at : at + PIECES]
                if len(max(short, key=len)) > BLOCK:
                    short = list(takewhile(lambda p: len(p) <= BLOCK, short))
                if short:
                    yield list(map(self.pieces.__getitem__, short))
                    at += len(short)
                else:
                    yield from self._long(pieces[at])
                    at += 1

    def encode(self, text: str | None) -> list[int]:
        return [int(i) for block in self.encode_pieces(text) for p in block for i in p.split(" ")]

    def decode(self, ids: Iterable[int]) -> str:
        return Decoder(self).text(ids)


class Decoder:
    """Text from token ids, in any number of calls; special tokens stay.

    Without a decoder in the tokenizer's file the text is the tokens joined by a space. `bytes_text` gives the
    text that the tokens spell. Either way a token's bytes go through an incremental UTF-8 machine, which keeps
    at most three bytes of a character whose end has not come yet.
    """

    def __init__(self, codec: Codec):
        self.codec, self.begun, self.utf8 = codec, False, codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[str]) -> str:
        """The text that ids in decimal add. Unknown ids add nothing."""
        spelled = self.codec.spelled
        try:
            found = list(map(spelled.__getitem__, ids))
        except KeyError:
            found = [spelled[i] for i in ids if i in spelled]
        if not found:
            return ""
        lead, self.begun = b" " if self.begun else b"", True
        return self.utf8.decode(lead + b" ".join(found))

    def end(self) -> str:
        """What is left when no more ids come."""
        return self.utf8.decode(b"", True)

    def text(self, ids: Iterable[int]) -> str:
        return self.feed([str(i) for i in ids])

    def bytes_text(self, ids: Iterable[int], end: bool = False) -> str:
        suffix, out = self.codec.transducer.suffix, []
        for i in ids:
            t = self.codec.token.get(i)
            if t is None:
                continue
            if t in self.codec.special:
                out.append(self.utf8.decode(b"", True) + t)
                self.utf8.reset()
                continue
            space = suffix and t.endswith(suffix)
            t = t[: -len(suffix)] if space else t
            out.append(self.utf8.decode(bytes(self.codec.byte[c] for c in t)) + " " * bool(space))
        return "".join(out) + (self.utf8.decode(b"", True) if end else "")


def codec_of(spec: str) -> Codec:
    return worker_keeps(("codec", spec), lambda: Codec(spec))


def read_spec(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def _mapped(df: DataFrame, text_col: str, fields: list[T.StructField], spec: str, row, keep: list[str] | None = None) -> DataFrame:
    """`df`, or its columns `keep`, with new fields: row(codec, value of text_col) gives their values. The tokenizer's file is read by the driver and broadcast."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    names = [f.name for f in fields]
    kept = [f for f in df.schema.fields if f.name not in names and (keep is None or f.name in keep)]
    columns, schema = [f.name for f in kept], T.StructType([*kept, *fields])
    arrow = to_arrow_schema(T.StructType(fields))
    shared = df.sparkSession.sparkContext.broadcast(spec)

    def run(batches):
        codec, last, found = codec_of(shared.value), None, None
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                made = []
                for x in batch.column(text_col):
                    value = x.as_py()
                    if found is None or value != last:  # a mix has the copies of a row one after the other
                        last, found = value, row(codec, value)
                    made.append(found)
                new = [pa.array([m[k] for m in made], arrow.field(k).type) for k in range(len(names))]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *new], names=[*columns, *names])

    return map_arrow(df, run, schema)


def encode_documents(df: DataFrame, path: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """`df` with array<int> `out`: each text's token ids."""
    return _mapped(df, text_col, [T.StructField(out, T.ArrayType(T.IntegerType()))], read_spec(path), lambda c, x: (c.encode(x),))


def decode_documents(df: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """`df` with string `out`: the text of each array of ids; null counts as no ids."""
    return _mapped(df, ids_col, [T.StructField(out, T.StringType())], read_spec(path), lambda c, x: (c.decode(x or []),))


def _digest(codec: Codec, text: str | None) -> tuple[int, str, str]:
    ids, decoded, n, lead, machine = hashlib.sha256(), hashlib.sha256(), 0, "", Decoder(codec)
    for block in codec.encode_pieces(text):
        line = " ".join(block)
        if line:
            ids.update((lead + line).encode())
            own, lead = line.split(" "), " "
            n += len(own)
            decoded.update(machine.feed(own).encode())
    decoded.update(machine.end().encode())
    return n, ids.hexdigest(), decoded.hexdigest()


def digest_documents(df: DataFrame, path: str, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`df`, or its columns `keep`, with n_tokens, ids_sha256 and decoded_sha256 of its encoding and of what that decodes to, both handled in blocks."""
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    return _mapped(df, text_col, fields, read_spec(path), _digest, keep)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_documents(documents(spark, sf_dir).select("doc_id", "text"), default_path(), keep=["doc_id"])


QUERIES = {"op1_bpe": op1_bpe}
SQL: dict[str, str] = {}

"""Token counts by a compiled finite-state tokenizer.

The vocabulary of a merge tokenizer (sentencepiece BPE model) is compiled to a deterministic
transducer over characters. The encoding of a prefix ends in exactly one token, and two tokens may
stand side by side only if encoding their joint text gives back the two; so the last token and the
count of every prefix follow from those of the shorter prefixes at which a token can still be open.
These open positions - trie node, last token before it, count relative to now - are the state; each
transition is annotated with the change of the emitted-token count. States and transitions are built
when first met and kept (a lazily determinised automaton, bounded by ``MAX_STATES``).

No token of the model crosses from a character into a following space, so the automaton may be put back in its
start state at every word start; counts of whole words are remembered per process. Texts of more bytes than
``chunk_chars`` are cut into chunks of as many characters that Spark deals to the tasks, equal chunks of equal
texts once. The map of a chunk takes an entry state to the exit state and the number of tokens in between. It
is worked out at the entry state that the ``LOOK_BACK`` characters before the chunk foretell, then at every exit state
of the chunk before it that it lacks, until none is missing: mostly at once, else after as many rounds as the chunks
have states in turn, not as there are chunks. The maps of a text are then composed in order. A text without any
space therefore also spreads over the tasks; what is held per text at a time is the maps of its chunks (a text of
2 GB, Spark's limit, has 32,768 chunks).

Characters outside the vocabulary count their UTF-8 bytes (byte fallback) and reset the state.
Defined cases: null and empty texts have no tokens; an id that is null or repeated stays as it is, a row each;
very long texts count whole; an empty table gives no rows; other columns of any name are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultweave.llm import textbytes as tb
from vaultweave.llm.common import saved, table

LIMIT = 4096
CHUNK_CHARS = 1 << 16
LOOK_BACK = 256
MAX_STATES = 250_000
MAX_WORDS = 600_000
SPACE = "▁"  # how the model writes a space


#: open positions: trie node, last token before it, count relative to now
State = tuple[tuple[int, int, int], ...]
START: State = ((0, -1, 0),)


class Transducer:
    """Counts the tokens of a string in which spaces are already written as ``SPACE``."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.names = list(scores)
        number = {p: i for i, p in enumerate(self.names)}
        self.children: list[dict[str, int]] = [{}]
        self.token = [-1]
        for p, i in number.items():
            if any(ch not in scores for ch in p):
                raise ValueError(f"piece {p!r} has a character that is no piece")
            node = 0
            for ch in p:
                nxt = self.children[node].get(ch)
                if nxt is None:
                    nxt = self.children[node][ch] = len(self.children)
                    self.children.append({})
                    self.token.append(-1)
                node = nxt
            if self._merge(p) == [p]:  # else no encoding ever holds it
                self.token[node] = i
        self._pairs: dict[int, bool] = {}
        self._reset_states()

    def _reset_states(self) -> None:
        self.states, self.number, self.delta = [START], {START: 0}, [{}]

    def _number_of(self, state: State) -> int:
        where = self.number.get(state)
        if where is None:
            where = self.number[state] = len(self.states)
            self.states.append(state)
            self.delta.append({})
        return where

    def _merge(self, text: str) -> list[str]:
        """Plain merging: the best-scored neighbours first, the leftmost of equals."""
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = scores.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _together(self, a: int, b: int) -> bool:
        """May token b follow token a?"""
        if a < 0:
            return True
        key = a << 32 | b
        ok = self._pairs.get(key)
        if ok is None:
            x, y = self.names[a], self.names[b]
            ok = self._pairs[key] = self._merge(x + y) == [x, y]
        return ok

    def _step(self, state: int, ch: str) -> tuple[int, int]:
        """Builds one transition: next state and change of the count."""
        if ch not in self.scores:
            return 0, len(ch.encode("utf-8", "surrogatepass"))
        moved, last, count = [], None, 0
        for node, before, rel in self.states[state]:
            nxt = self.children[node].get(ch)
            if nxt is None:
                continue
            t = self.token[nxt]
            if last is None and t >= 0 and self._together(before, t):
                last, count = t, rel + 1
            if self.children[nxt]:
                moved.append((nxt, before, rel))
        return self._number_of(tuple(sorted((n, b, r - count) for n, b, r in moved)) + ((0, last, 0),)), count

    def run(self, text: str, entry: State = START) -> tuple[State, int]:
        """The state after ``text`` and the tokens it adds, from state ``entry``."""
        if len(self.states) > MAX_STATES:
            self._reset_states()
        state, total, delta = self._number_of(entry), 0, self.delta
        for ch in text:
            arc = delta[state].get(ch)
            if arc is None:
                arc = delta[state][ch] = self._step(state, ch)
            state = arc[0]
            total += arc[1]
        return self.states[state], total


_SEGMENT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_START = re.compile(f"(?<!{SPACE}){SPACE}")
_LOADED: dict[str, Counter] = {}


class Counter:
    """Counts whole texts: chunk maps over the transducer, with the counts of whole words remembered."""

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        scores = {model.id_to_piece(i): model.get_score(i) for i in ids}
        if any(SPACE in p.lstrip(SPACE) for p in scores):
            raise ValueError("a piece goes on after a space; word starts would not reset the state")
        self.machine = Transducer(scores)
        self.words: dict[str, int] = {}

    def segment(self, text: str) -> int:
        n = self.words.get(text)
        if n is None:
            if len(self.words) >= MAX_WORDS:
                self.words.clear()
            n = self.machine.run(text)[1]
            if len(text) <= 64:
                self.words[text] = n
        return n

    def through(self, chunk: str, entry: State) -> tuple[State, int]:
        """The map of a chunk at one entry state: exit state and tokens."""
        first = next((m.start() for m in _START.finditer(chunk, 1)), None)
        if first is None:
            return self.machine.run(chunk, entry)
        segments = _SEGMENT.findall(chunk, first)
        _, head = self.machine.run(chunk[:first], entry)
        out, tail = self.machine.run(segments[-1])
        return out, head + sum(map(self.segment, segments[:-1])) + tail

    def foretold(self, before: str, chunk: str) -> State:
        """The state in which a chunk is probably entered, by the text before it; surely if that holds a word start."""
        if _starts(before, chunk):
            return START
        return self.machine.run(before[max((m.start() for m in _START.finditer(before)), default=0):])[0]

    def text(self, text: str, chunk_chars: int = CHUNK_CHARS) -> int:
        if not text:
            return 0
        if len(text) <= chunk_chars and SPACE not in text and "  " not in text and text[0] != " " and text[-1] != " ":
            words, total = self.words, 0
            for w in text.split(" "):  # one chunk whose words each stand alone
                n = words.get(SPACE + w)
                total += self.segment(SPACE + w) if n is None else n
            return total
        state, total = START, 0
        for before, chunk in chunks(text, chunk_chars):
            state, n = self.through(chunk, START if _starts(before, chunk) else state)
            total += n
        return total


def chunks(text: str, chunk_chars: int, look_back: int = LOOK_BACK):
    """(the characters before it, chunk) of a text with its spaces written as ``SPACE``."""
    text = SPACE + text.replace(" ", SPACE)
    for i in range(0, len(text), chunk_chars):
        yield text[max(0, i - look_back):i], text[i:i + chunk_chars]


def _starts(left: str, right: str) -> bool:
    """Does a word start where ``right`` follows ``left``, as at the start of a text?"""
    return not left or right.startswith(SPACE) and not left.endswith(SPACE)


def counter(model_file: str) -> Counter:
    """The process's counter of a model; compiled once."""
    if model_file not in _LOADED:
        _LOADED[model_file] = Counter(model_file)
    return _LOADED[model_file]


_CHUNK = "key string, seq long, before string, chunk string"


def _cut(chunk_chars: int, look_back: int):
    """Rows (key, text) to the chunks of each text, a few at a time."""
    def run(batches):
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                rows = []
                for seq, (before, chunk) in enumerate(chunks(text.as_py(), chunk_chars, look_back)):
                    rows.append((key.as_py(), seq, before, chunk))
                    if len(rows) == 16:
                        yield _batch(rows)
                        rows = []
                if rows:
                    yield _batch(rows)
    return run


def _batch(rows):
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.string(), pa.string()), strict=True)],
                                      ["key", "seq", "before", "chunk"])


def _written(state: State) -> str:
    return " ".join(str(x) for place in state for x in place)


def _read(state: str) -> State:
    n = [int(x) for x in state.split()]
    return tuple(zip(n[::3], n[1::3], n[2::3], strict=True))


def _mapped(model_file: str):
    """Chunks, with a true entry state where it is known, to their maps at the true or foretold entry state."""
    def run(batches):
        c = counter(model_file)
        for batch in batches:
            out = []
            for before, chunk, entry in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                state = _read(entry) if entry else c.foretold(before, chunk)
                left, n = c.through(chunk, state)
                out.append((_starts(before, chunk), _written(state), _written(left), n))
            word, entry, left, n = zip(*out, strict=True) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(word, pa.bool_()), pa.array(entry, pa.string()), pa.array(left, pa.string()),
                                              pa.array(n, pa.int64())], ["key", "seq", "word", "entry", "exit", "n"])
    return run


def long_counts(long: DataFrame, model_file: str, chunk_chars: int, look_back: int = LOOK_BACK) -> DataFrame:
    """``key, n_tokens`` of texts (``key``, ``text``; equal keys, equal texts) whose chunks are counted apart."""
    pieces = long.mapInArrow(_cut(chunk_chars, look_back), _CHUNK).dropDuplicates(["key", "seq"])
    out = "key string, seq long, word boolean, entry string, exit string, n long"
    maps = saved(pieces.withColumn("entry", F.lit(None).cast("string")).mapInArrow(_mapped(model_file), out), "chunk_maps")
    inside = maps.filter(~F.col("word")).select("key", "seq").distinct()
    while True:
        after = maps.select("key", (F.col("seq") + 1).alias("seq"), F.col("exit").alias("entry")).distinct().join(inside, ["key", "seq"], "left_semi")
        need = after.join(maps.select("key", "seq", "entry"), ["key", "seq", "entry"], "left_anti")
        if need.isEmpty():
            break
        more = pieces.join(need, ["key", "seq"]).select("key", "seq", "before", "chunk", "entry").mapInArrow(_mapped(model_file), out)
        maps = saved(maps.unionByName(more), "chunk_maps")
    begin = F.struct(F.lit(_written(START)).alias("state"), F.lit(-1).cast("long").alias("seq"), F.lit(0).cast("long").alias("n"))

    def follow(at, m):
        goes_on = (m["seq"] == at["seq"] + 1) & (m["word"] | (m["entry"] == at["state"]))
        return F.when(goes_on, F.struct(m["exit"].alias("state"), m["seq"].alias("seq"), (at["n"] + m["n"]).alias("n"))).otherwise(at)

    return (maps.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("seq", "word", "entry", "exit", "n"))).alias("maps"))  # a text's chunks
            .select("key", F.aggregate("maps", begin, follow, lambda at: at["n"]).alias("n_tokens")))


def token_counts(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` per row. The model file must be readable on the executors."""

    def run(batches):
        count = counter(model_file).text
        for batch in batches:
            data, offs = tb.utf8(batch.column(1))
            raw = data.tobytes()
            n = [count(raw[offs[i]:offs[i + 1]].decode("utf-8", "replace")) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offs), pa.int64()), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    short = rows.filter(size <= chunk_chars).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    long = rows.filter(size > chunk_chars).withColumn("key", F.sha2(F.col("text").cast("binary"), 256))
    counts = long_counts(long.select("key", "text"), model_file, chunk_chars)
    long = long.select("doc_id", size.cast("long").alias("n_bytes"), "key").join(counts, "key").select("doc_id", "n_bytes", "n_tokens")
    return short.unionByName(long).withColumn("over_limit", F.col("n_tokens") > limit)


def op7_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))

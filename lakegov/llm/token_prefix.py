"""Token counts by prefix dynamic programming over a byte-level BPE vocabulary.

For every prefix of a piece the program stores the last token of the prefix's
encoding and its count. A token ``t`` ending at ``i`` is the last token of
prefix ``i`` exactly if it may follow the last token of prefix ``i - len(t)``,
that is if encoding the two together gives the two back; there is always
exactly one such token. So one pass gives the exact count at *every* prefix,
and truncation and budget questions are answered without encoding again:
``prefix_counts`` stores the table, ``longest_prefix`` reads it. The registered
counts come from the same table: the running counts of every space-separated
chunk are stored once per worker, a text's counts are theirs one after the
other, its total the last of them and its cut the place where they pass the limit.

Pieces come from the vocabulary's splitting pattern. A prefix may end inside a
piece; where cutting changes the pieces (white-space runs, contractions, a
special token cut in two) the tail is taken from a run of its own, so counts
are those of encoding the cut text.

Which code points are letters and numbers is asked of the library's own splitter
wherever two Unicode versions on this machine disagree.

Texts are whole; the stored chunks are bounded in number. Defined cases: a null text is empty (0 tokens); a special string inside
a text counts as the library's default does (one token); null and repeated ids
are kept as they are, one result row per input row; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Sequence

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegov.llm.staging import map_arrow

LIMIT = 512
MEMO_ENTRIES = 350_000   # chunks in each of the memo's two generations, and token pairs, that a worker remembers
MEMO_CHARS = 48          # longer chunks are not remembered
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # fixed by the vocabulary


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabulary files:
    printable Latin-1 stands for itself, the rest follows from U+0100."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _ranges(points: list[int]) -> str:
    """A character class body of sorted code points."""
    out: list[list[int]] = []
    for c in points:
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(f"\\U{a:08X}-\\U{b:08X}" for a, b in out)


def splitting_pattern(path: str) -> str:
    """``PIECES`` with the library's letters and numbers. Code points on which the
    pattern engine and Python's own tables differ (they know different Unicode
    versions) are handed to the library's splitter behind a letter and behind a
    digit: what it leaves in one piece is of that kind."""
    from tokenizers import Tokenizer

    every = "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)))
    pieces = PIECES
    split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    not_of: dict[str, str] = {}
    for kind, head in (("L", "a"), ("N", "1")):
        engine = set(regex.findall(rf"\p{{{kind}}}", every))
        python = {c for c in every if unicodedata.category(c)[0] == kind}
        doubtful = sorted(engine ^ python)
        library = set()
        for lo in range(0, len(doubtful), 4096):
            part = doubtful[lo:lo + 4096]
            asked = "".join(f" {head}{c}" for c in part)
            whole = {at for _, at in split(asked)}
            library |= {c for i, c in enumerate(part) if (3 * i, 3 * i + 3) in whole}
        out = _ranges([ord(c) for c in sorted(set(doubtful) & engine - library)])
        more = _ranges([ord(c) for c in sorted(library - engine)])
        not_of[kind] = rf"[^\P{{{kind}}}{out}]" if not more else rf"(?:[^\P{{{kind}}}{out}]|[{more}])"
        not_of[f"not {kind}"] = rf"[\P{{{kind}}}{out}]" if not more else rf"(?![{more}])[\P{{{kind}}}{out}]"
    if not_of == {"L": r"[^\P{L}]", "not L": r"[\P{L}]", "N": r"[^\P{N}]", "not N": r"[\P{N}]"}:
        return pieces
    other = rf"(?:(?={not_of['not L']})(?={not_of['not N']})\S)"
    return pieces.replace(r"[^\s\p{L}\p{N}]", other).replace(r"\p{L}", not_of["L"]).replace(r"\p{N}", not_of["N"])


NEVER = 1 << 30


class PrefixCounter:
    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        of = byte_alphabet()
        raw = lambda s: bytes(of[c] for c in s)
        self.special = [t["content"] for t in spec["added_tokens"]]
        hidden = set(self.special)
        self.vocab = {raw(t): i for t, i in spec["model"]["vocab"].items() if t not in hidden}
        #: every ending of a token; -1 where it is no token itself
        self.tails = {t[i:]: -1 for t in self.vocab for i in range(1, len(t))} | self.vocab
        pairs = [tuple(map(raw, m.split(" ") if isinstance(m, str) else m)) for m in spec["model"]["merges"]]
        self.rank = {(self.vocab[a] << 20) | self.vocab[b]: r for r, (a, b) in enumerate(pairs)}
        self.made_of: dict[int, tuple[int, int, int]] = {}
        for r, (x, y) in enumerate(pairs):
            self.made_of.setdefault(self.vocab[x + y], (self.vocab[x], self.vocab[y], r))
        self.pattern = regex.compile(splitting_pattern(path))
        self.ascii_pattern = regex.compile(PIECES)     # the versions agree on ASCII
        self.white = frozenset(regex.findall(r"\s", "".join(map(chr, range(0xD800)))))
        self.odd_space = regex.compile(r"\s (?:\s|\Z)")
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.edges: dict[int, tuple[list, list]] = {}
        self.alone: dict[int, bool] = {}
        self.follows: dict[int, bool] = {}
        self.young: dict[str, Sequence[int]] = {}
        self.old: dict[str, Sequence[int]] = {}

    # -- the dynamic program ------------------------------------------------
    def edge(self, token: int) -> tuple[list, list]:
        """How the token's first and last part grow while it is merged: lists of
        (part, rank of the merge that ends it), the token itself last."""
        known = self.edges.get(token)
        if known is None:
            parts = self.made_of.get(token)
            if parts is None:
                known = ([(token, NEVER)], [(token, NEVER)])
            else:
                x, y, r = parts
                left, right = self.edge(x)[0], self.edge(y)[1]
                known = ([*left[:-1], (left[-1][0], r), (token, NEVER)], [*right[:-1], (right[-1][0], r), (token, NEVER)])
            self.edges[token] = known
        return known

    def apart(self, before: int, token: int, until: int = -1) -> bool:
        """Whether merging by rank (up to rank ``until``, or to the end) never joins
        the two across their border. At any time only the last part of one and the
        first part of the other touch; the lower rank goes first, of equal ranks
        the one further left."""
        left, right = self.edge(before)[1], self.edge(token)[0]
        i = j = 0
        end = NEVER if until < 0 else until
        while True:
            (a, ends_a), (b, ends_b) = left[i], right[j]
            q = self.rank.get((a << 20) | b, NEVER)
            if q < end and q < ends_a and q <= ends_b:
                return False
            if ends_a == ends_b == NEVER:
                return True
            if ends_a <= ends_b:
                i += 1
            else:
                j += 1

    def stands_alone(self, token: int) -> bool:
        """Whether the token's bytes are encoded as this one token."""
        known = self.alone.get(token)
        if known is None:
            parts = self.made_of.get(token)
            known = parts is None or (self.stands_alone(parts[0]) and self.stands_alone(parts[1])
                                      and self.apart(parts[0], parts[1], parts[2]))
            self.alone[token] = known
        return known

    def piece_counts(self, piece: bytes) -> list[int]:
        """Exact token count of every prefix of a piece, the empty one first."""
        n = len(piece)
        last, count = [0] * (n + 1), [0] * (n + 1)
        tails, follows = self.tails.get, self.follows
        for i in range(1, n + 1):
            s = i
            while True:   # candidates from the shortest on; exactly one fits
                s -= 1
                t = tails(piece[s:i])
                if t >= 0:
                    if s == 0:
                        if self.stands_alone(t):
                            break
                    else:
                        key = (last[s] << 20) | t
                        fits = follows.get(key)
                        if fits is None:
                            if len(follows) >= MEMO_ENTRIES:
                                follows.clear()
                            fits = follows[key] = self.stands_alone(t) and self.apart(last[s], t)
                        if fits:
                            break
            last[i], count[i] = t, count[s] + 1
        return count

    # -- counts of whole texts ----------------------------------------------
    def _chunk_prefixes(self, chunk: str) -> Sequence[int]:
        """Counts at every prefix of a space and a chunk without one."""
        plain = chunk.isascii()
        first, *more = (self.ascii_pattern if plain else self.pattern).findall(chunk)
        if first[0] != " " or len(first) < 2:
            out = self._plain_prefixes(chunk)
        elif not more:
            counts = self.piece_counts(first.encode())
            if plain:
                out = counts
            else:
                out, at = [0], 0
                for ch in first:
                    at += len(ch.encode())
                    out.append(counts[at])
        else:
            out = [*self._remember(first[1:])]
            base, rest = out[-1], chunk[len(first):]
            if plain and len(rest) == 1:
                out.append(base + 1)
            else:
                out += [base + c for c in self._plain_prefixes(rest)[1:]]
        return bytes(out) if max(out) < 256 else out

    def _chunks(self, text: str) -> list[Sequence[int]] | None:
        """Prefix counts of the space-separated chunks, the space before a chunk
        belonging to it: a space that something else than white space follows
        always begins a piece. None where runs of white space make that wrong."""
        if self.odd_space.search(text):
            return None
        head, *rest = text.split(" ")
        stored = list(map(self.young.get, rest))
        if None in stored:
            for i, c in enumerate(stored):
                if c is None:
                    stored[i] = self._remember(rest[i])
        return [self._plain_prefixes(head), *stored]

    def _remember(self, chunk: str) -> Sequence[int]:
        """Prefix counts of a chunk behind a space, from the store of two generations:
        what was not asked for during the last one goes."""
        c = self.young.get(chunk)
        if c is None:
            c = self.old.get(chunk)
            if c is None:
                c = self._chunk_prefixes(" " + chunk)
            if len(chunk) <= MEMO_CHARS:
                if len(self.young) >= MEMO_ENTRIES:
                    self.old, self.young = self.young, {}
                self.young[chunk] = c
        return c

    def count(self, text: str) -> int:
        return self.count_and_fit(text, 0)[0]

    def _plain_prefixes(self, text: str) -> list[int]:
        """Counts at every prefix of a text without special strings, by code point."""
        out, base, run_at, run_base = [0], 0, None, 0
        for m in (self.ascii_pattern if text.isascii() else self.pattern).finditer(text):
            piece, a = m.group(), m.start()
            counts = self.piece_counts(piece.encode())
            at = 0
            for j, ch in enumerate(piece):
                at += len(ch.encode())
                if ch in self.white:
                    if run_at is None:
                        run_at, run_base = a + j, base if j == 0 else base + counts[at - len(ch.encode())]
                    run = text[run_at:a + j + 1].encode()
                    out.append(run_base + self.piece_counts(run)[-1])
                    continue
                run_at = None
                if piece in ("'re", "'ve", "'ll") and j == 1:
                    out.append(base + 2)   # a contraction cut short is a mark and a letter
                else:
                    out.append(base + counts[at])
            base += counts[-1]
        return out

    def prefixes(self, text: str) -> list[int]:
        """Token count of every prefix of ``text`` by code point, the empty one first."""
        out, base, at = [0], 0, 0
        for m in (self.cut.finditer(text) if self.cut else ()):
            part = text[at:m.start()]
            plain = self._plain_prefixes(part + m.group())   # a special string cut in two is ordinary text
            own = self._plain_prefixes(part)
            out += [base + c for c in own[1:]] + [base + c for c in plain[len(part) + 1:-1]] + [base + own[-1] + 1]
            base, at = base + own[-1] + 1, m.end()
        return out + [base + c for c in self._plain_prefixes(text[at:])[1:]]

    def count_and_fit(self, text: str, limit: int) -> tuple[int, int]:
        """(tokens, code points of the longest prefix of at most ``limit`` tokens),
        both read from the prefix counts of one pass."""
        chunks = None if self.cut and self.cut.search(text) else self._chunks(text)
        if chunks is None:
            every = self.prefixes(text)
            n = every[-1]
            return n, len(text) if n <= limit else max(i for i, c in enumerate(every) if c <= limit)
        n = sum([c[-1] for c in chunks])
        if n <= limit:
            return n, len(text)
        base = at = fit = 0
        for chunk in chunks:
            # a cut inside a contraction may take more tokens than the whole, so counts are not sorted
            within = [i for i, c in enumerate(chunk) if base + c <= limit]
            if within:
                fit = at + within[-1]
            if base > limit:
                break
            base += chunk[-1]
            at += len(chunk) - 1
        return n, fit


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """One counter, with its memo, per Python worker and vocabulary."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit, fit_chars) per row; ``fit_chars``
    is where to cut the text so that at most ``limit`` tokens stay."""
    def run(batches):
        c = counter(path)
        for b in batches:
            rows = [(len(t.encode()), *c.count_and_fit(t, limit)) for t in (x.as_py() or "" for x in b["t"])]
            nb, nt, fit = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b["id"], pa.array(nb, pa.int64()), pa.array(nt, pa.int64()),
                 pa.array([n > limit for n in nt], pa.bool_()), pa.array(fit, pa.int64())],
                names=[id_col, "n_bytes", "n_tokens", "over_limit", "fit_chars"])

    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("t"))
    return map_arrow(d, run, f"{id_col} long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long")


def prefix_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, prefix_tokens): the stored table; element ``i`` (from 0) is the token count of the first ``i`` code points."""
    def run(batches):
        c = counter(path)
        for b in batches:
            for i in range(b.num_rows):
                yield pa.RecordBatch.from_arrays(
                    [b["id"].slice(i, 1), pa.array([c.prefixes(b["t"][i].as_py() or "")], pa.list_(pa.int32()))],
                    names=[id_col, "prefix_tokens"])

    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("t"))
    return map_arrow(d, run, f"{id_col} long, prefix_tokens array<int>")


def longest_prefix(budget: int, prefix_tokens: str = "prefix_tokens") -> Column:
    """Code points of the longest prefix within ``budget`` tokens, from the stored table."""
    return F.array_max(F.transform(prefix_tokens, lambda c, i: F.when(c <= budget, i)))

"""Secret scan with structural confirmation.

Base spans come from three patterns (assignments, access keys, long hex). On top, base64, base64url or
hex characters are decoded and reported only if the bytes have the structure of a secret: nested DER lengths
that fill the value exactly, an SSH key blob, certificate or private-key container of known fields, or the
header of a signed token with its algorithm. Random base64 or hex does not parse. Every start of a base64 piece is tried (a line,
or what follows armour or another character), over line ends, up to where the structure's own lengths end: what stands on
the lines around it plays no part.

Edge cases: NULL or empty text: no span. Any number of repeated rows: each is scanned. Extra columns
are ignored. Texts are scanned whole. Runs of lines are read and decoded once, whatever starts in them, and a start is rejected as soon as
its own lengths exceed what is left of the run or its first wrong byte is met.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from shoal.llm.common import append_columns, bounded_batches

#: The base patterns, in the order spans at one start are listed.
ASSIGN = re.compile(r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "der", "ssh", "jwt")

#: Where a structure can start: a DER sequence, a length below 2^8 of a blob's name, a container's magic; a token's header.
START = re.compile(r"(?:(?<![A-Za-z0-9+/_-])|(?<=-----))(?:M[A-P]|AAAA|b3BlbnNzaC1rZXktdjE)")
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])ey")
PIECE, BREAK, PAD = re.compile(r"[A-Za-z0-9+/_-]+"), re.compile(r"\r?\n(?=[A-Za-z0-9+/_])"), re.compile(r"={0,2}")
URL_PIECE, URL_BREAK = re.compile(r"[A-Za-z0-9_-]+"), re.compile(r"\r?\n(?=[A-Za-z0-9_-])")
#: Characters of the signatures whose size follows from the algorithm.
SIGNATURE = {"HS256": 43, "HS384": 64, "HS512": 86, "ES256": 86, "ES384": 128, "ES512": 176, "EdDSA": 86}
#: Length-prefixed fields (s) after the name of an SSH key, and what a certificate adds to them (8 and 4 bytes: Q, I).
SSH_FIELDS = {"ssh-rsa": "ss", "ssh-dss": "ssss", "ssh-ed25519": "s", "ssh-ed448": "s", "ecdsa-sha2-nistp256": "ss",
              "ecdsa-sha2-nistp384": "ss", "ecdsa-sha2-nistp521": "ss", "sk-ssh-ed25519": "ss", "sk-ecdsa-sha2-nistp256": "sss"}
CERTIFICATE = "QIssQQsssss"
HEX_RUN = re.compile(r"[0-9A-Fa-f]{32,}")
DECODER = json.JSONDecoder()


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind as listed."""
    out = []
    low = text.lower()
    if any(w in low for w in ("password", "passwd", "secret", "token", "apikey", "api_key")):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], BASE.index(s[2])))


def der_fills(raw: bytes, depth: int = 0) -> bool:
    """Do DER elements fill ``raw`` exactly, constructed ones recursively?"""
    at, n = 0, len(raw)
    while at < n:
        if at + 2 > n:
            return False
        tag, size = raw[at], raw[at + 1]
        at += 2
        if size & 0x80:
            k = size & 0x7F
            if not 1 <= k <= 4 or at + k > n:
                return False
            size = int.from_bytes(raw[at:at + k], "big")
            if size < 0x80 or raw[at] == 0:  # the shortest form only
                return False
            at += k
        if at + size > n or tag == 0:
            return False
        if tag & 0x20 and (depth >= 12 or not der_fills(raw[at:at + size], depth + 1)):
            return False
        at += size
    return True


def is_der(raw: bytes) -> bool:
    """One DER sequence of some size that starts with an integer or another sequence: the shape of every key encoding
    (PKCS #1, PKCS #8, SEC 1, public key info)."""
    return len(raw) >= 24 and raw[0] == 0x30 and der_fills(raw) and der_count(raw) == 1 and \
        raw[2 + (raw[1] & 0x7F if raw[1] & 0x80 else 0)] in (0x02, 0x30)


def der_count(raw: bytes) -> int:
    """Elements at the top level of well-formed DER."""
    at = n = 0
    while at < len(raw):
        size, at = raw[at + 1], at + 2
        if size & 0x80:
            k = size & 0x7F
            size, at = int.from_bytes(raw[at:at + k], "big"), at + k
        at, n = at + size, n + 1
    return n


def fields(raw: bytes) -> list[bytes] | None:
    """Length-prefixed fields that fill ``raw`` exactly."""
    at, out = 0, []
    while at < len(raw):
        size = int.from_bytes(raw[at:at + 4], "big")
        if at + 4 > len(raw) or at + 4 + size > len(raw) or len(out) > 16:
            return None
        out.append(raw[at + 4:at + 4 + size])
        at += 4 + size
    return out


def is_ssh(raw: bytes) -> bool:
    """An SSH key blob, or the private-key container."""
    if raw.startswith(b"openssh-key-v1\0"):
        return len(raw) > 40
    got = fields(raw) if len(raw) >= 16 and raw[:2] == b"\0\0" else None
    return bool(got) and len(got) >= 2 and re.fullmatch(rb"(ssh|ecdsa|sk)-[a-z0-9@.-]+", got[0]) is not None


class Run:
    """The base64 characters of a text from ``at`` on, over line ends, up to the end of the run. It is read once for all structures
    that start in it; what lies at one of the four alignments is decoded once."""

    def __init__(self, text: str, at: int, piece: re.Pattern, gap: re.Pattern):
        self.text, self.begin, lines, first, chars = text, at, [], [], 0
        while m := piece.match(text, at):
            lines.append(m)
            first.append(chars)
            chars, at = chars + m.end() - m.start(), m.end()
            if not (g := gap.match(text, at)):
                break
            at = g.end()
        self.lines, self.starts, self.first, self.chars = lines, [m.start() for m in lines], first, chars
        self.end = lines[-1].end() if lines else self.begin
        self._clean, self._decoded, self._spelled = None, {}, {}

    def place(self, at: int) -> int:
        """Characters of the run before a position of the text in it."""
        i = bisect.bisect_right(self.starts, at) - 1
        return self.first[i] + at - self.starts[i]

    def where(self, chars: int) -> int:
        """Position in the text after so many characters of the run."""
        i = bisect.bisect_left(self.first, chars) - 1
        return self.starts[i] + chars - self.first[i]

    def decoded(self, chars: int) -> tuple[bytes, int]:
        """Bytes at the alignment of a place in the run, and the number of those before it."""
        side = chars % 4
        if side not in self._decoded:
            if self._clean is None:
                self._clean = "".join(m.group() for m in self.lines).replace("-", "+").replace("_", "/")
            left = self.chars - side
            kept = self._clean[side:self.chars - (left % 4 == 1)]
            self._decoded[side] = base64.b64decode(kept + "=" * (-len(kept) % 4))
        return self._decoded[side], (chars - side) // 4 * 3

    def spelled(self, side: int) -> tuple[str, int]:
        """What :meth:`decoded` gave for an alignment as one character a byte, and where the white space at its end starts."""
        if side not in self._spelled:
            raw = self._decoded[side]
            self._spelled[side] = raw.decode("latin-1"), len(raw.rstrip(b" \t\r\n"))
        return self._spelled[side]


class Reader:
    """The bytes from one place of a run on."""

    def __init__(self, run: Run, at: int):
        self.run, self.place = run, run.place(at)
        self.bytes, self.at = run.decoded(self.place)
        self.left = len(self.bytes) - self.at

    def read(self, start: int, size: int) -> bytes | None:
        """``size`` bytes from ``start`` on, None if the run ends before."""
        if start + size > self.left:
            return None
        return self.bytes[self.at + start:self.at + start + size]

    def end(self, n: int) -> int:
        """Where the first ``n`` bytes end in the text, padding included."""
        need = -(-n * 4 // 3)
        end = self.run.where(self.place + need)
        return end + min(-need % 4, len(PAD.match(self.run.text, end).group()))

    def line_ends(self, n: int) -> bool:
        """Do the first ``n`` bytes end with a line?"""
        i = bisect.bisect_left(self.run.first, self.place + -(-n * 4 // 3))
        chars = (self.run.first[i] if i < len(self.run.first) else self.run.chars) - self.place
        return chars % 4 != 1 and chars * 3 // 4 == n


def der_size(r: Reader) -> int | None:
    """Bytes of the DER sequence that starts here, by its own length."""
    head = r.read(0, 2)
    if not head or head[0] != 0x30:
        return None
    if not head[1] & 0x80:
        return 2 + head[1]
    k = head[1] & 0x7F
    head = r.read(2, k) if 1 <= k <= 4 else None
    return 2 + k + int.from_bytes(head, "big") if head else None


def ssh_size(r: Reader) -> int | None:
    """Bytes of the SSH key, certificate or private-key container that starts here, by its own lengths. A blob of a type that is not
    listed goes up to the first of its fields' ends at which a line ends too, a container whose fields do not end up to the last line."""
    at = 0

    def number() -> int | None:
        nonlocal at
        got = r.read(at, 4)
        at += 4
        return None if got is None else int.from_bytes(got, "big")

    def walk(layout: str) -> bool:
        nonlocal at
        for kind in layout:
            size = {"Q": 8, "I": 4}.get(kind) or number()
            if size is None or at + size > r.left:
                return False
            at += size
        return True

    if r.read(0, 15) == b"openssh-key-v1\0":
        at = 15
        keys = number() if walk("sss") else None
        if keys is not None and 1 <= keys <= 16 and walk("s" * (keys + 1)) and at > 40:
            return at
        whole = (r.run.chars - r.place) * 3 // 4
        return whole if (r.run.chars - r.place) % 4 != 1 and whole > 40 else None
    size = number()
    name = r.read(4, size) if size is not None and 4 <= size <= 255 else None
    if name is None or not re.fullmatch(rb"(ssh|ecdsa|sk)-[a-z0-9@.-]+", name):
        return None
    begin = at = 4 + size
    full = name.decode().removesuffix("@openssh.com")
    plain = full.removesuffix("-cert-v01")
    if plain in SSH_FIELDS and walk(SSH_FIELDS[plain] if plain == full else "s" + SSH_FIELDS[plain] + CERTIFICATE):
        return at
    at = begin
    for _ in range(16):
        if not walk("s"):
            return None
        if at >= 16 and r.line_ends(at):
            return at
    return None


def json_object(run: Run, chars: int) -> dict | None:
    """The JSON object that the run spells from a place on. Scanning stops at the first character that cannot be part of it."""
    raw, at = run.decoded(chars)
    if raw[at:at + 1] != b"{" or raw[at + 1:at + 2] not in (b'"', b" ", b"\t", b"\r", b"\n", b"}"):
        return None
    latin, last = run.spelled(chars % 4)
    try:
        _, end = DECODER.raw_decode(latin, at)
        return json.loads(raw[at:].decode("utf-8")) if end >= last else None
    except (ValueError, RecursionError):
        return None


class Tokens:
    """Signed tokens of one text. Runs of header and payload characters are read once, whatever starts in them."""

    def __init__(self, text: str):
        self.text, self.held, self.bodies = text, [], {}

    def run(self, at: int) -> Run:
        """The run that ``at`` lies in. A header's stays while its payload's is read."""
        for r in self.held:
            if r.begin <= at < r.end:
                return r
        self.held = [*self.held[-1:], Run(self.text, at, URL_PIECE, URL_BREAK)]
        return self.held[-1]

    def part(self, at: int) -> tuple[dict | None, int]:
        """The JSON object that the base64 characters from ``at`` on spell up to a dot, and where that stands."""
        run = self.run(at)
        if not run.lines or self.text[run.end:run.end + 1] != ".":
            return None, run.end
        place = run.place(at)
        if (run.chars - place) % 4 == 1:
            return None, run.end
        return json_object(run, place), run.end

    def end(self, at: int) -> int | None:
        """End of the signed token that starts here. Its parts may be broken by line ends; the signature goes over one only if
        that brings it to just the size its algorithm has."""
        head, dot = self.part(at)
        if head is None or not isinstance(head.get("alg"), str):
            return None
        if dot not in self.bodies:
            self.bodies[dot] = self.part(dot + 1)
        body, dot = self.bodies[dot]
        if body is None:
            return None
        at = dot + 1
        m = URL_PIECE.match(self.text, at)
        if not m:
            return None
        end, size, want = m.end(), m.end() - at, SIGNATURE.get(head["alg"], 0)
        further = end
        while size < want and (gap := URL_BREAK.match(self.text, further)):
            m = URL_PIECE.match(self.text, gap.end())
            size, further = size + m.end() - m.start(), m.end()
        return further if size == want else end


def confirmed(text: str) -> list[tuple[int, int, str]]:
    """Spans whose decoded content has the structure of a key or signed token."""
    out, done, tokens = [], 0, Tokens(text)
    for m in TOKEN.finditer(text):
        if m.start() >= done and (end := tokens.end(m.start())):
            out.append((m.start(), end, "jwt"))
            done = end
    done, run = 0, None
    for m in START.finditer(text):
        if m.start() < done:
            continue
        if run is None or m.start() >= run.end:
            run = Run(text, m.start(), PIECE, BREAK)
        r = Reader(run, m.start())
        if m.group()[0] == "M":
            kind, n = "der", der_size(r)
            raw = r.read(0, n) if n and is_der_start(r, n) else None
            n = n if raw and is_der(raw) else None
        else:
            kind, n = "ssh", ssh_size(r)
        if n:
            done = r.end(n)
            out.append((m.start(), done, kind))
    for m in HEX_RUN.finditer(text):
        run = m.group()
        if len(run) % 2 == 0 and run[:2] in ("30", "00", "6f", "6F"):
            raw = bytes.fromhex(run)
            if is_der(raw):
                out.append((m.start(), m.end(), "der"))
            elif is_ssh(raw):
                out.append((m.start(), m.end(), "ssh"))
    return out


def is_der_start(r: Reader, n: int) -> bool:
    """Does a sequence of ``n`` bytes, all there, go on like a key encoding? Settles most starts from a few bytes."""
    head = r.read(0, 8)
    if head is None or not 24 <= n <= r.left:
        return False
    at = 2 + (head[1] & 0x7F if head[1] & 0x80 else 0)
    return head[at] in (0x02, 0x30)


def spans(text: str) -> list[tuple[int, int, str]]:
    """All spans by start, then kind as listed; base spans always stay."""
    return sorted(set(base_spans(text)) | set(confirmed(text)), key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def digest(found: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in found)


def scan(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` with n_assign, n_access, n_hex, base_sha256 and spans, for every row."""
    bounded_batches(docs.sparkSession)

    def run(b: pa.RecordBatch):
        counts, sha, out = {k: [] for k in BASE}, [], []
        for text in b.column("text").to_pylist():
            base = base_spans(text or "")
            for k in BASE:
                counts[k].append(sum(s[2] == k for s in base))
            sha.append(hashlib.sha256(digest(base).encode()).hexdigest())
            out.append(digest(sorted(set(base) | set(confirmed(text or "")), key=lambda s: (s[0], KINDS.index(s[2]), s[1]))))
        return [*(pa.array(counts[k], pa.int64()) for k in BASE), pa.array(sha, pa.string()), pa.array(out, pa.string())]

    return append_columns(docs, carry, ["text"], run,
                          "n_assign long, n_access long, n_hex long, base_sha256 string, spans string")

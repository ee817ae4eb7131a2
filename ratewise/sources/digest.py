"""MD5 whose state can be handed from one task to the next.

``hashlib`` keeps its state to itself; OpenSSL's MD5 functions, which it is
linked to, hold theirs in a plain struct.  At a multiple of 64 bytes the
state is four words (and the number of bytes so far).
"""

from __future__ import annotations

import ctypes
import hashlib
import struct
from collections.abc import Iterable
from functools import cache

BLOCK = 64


class _Context(ctypes.Structure):  # MD5_CTX of openssl/md5.h
    _fields_ = [("words", ctypes.c_uint32 * 4), ("low", ctypes.c_uint32), ("high", ctypes.c_uint32),
                ("data", ctypes.c_uint32 * 16), ("num", ctypes.c_uint)]


def _carry(lib, pieces: Iterable[bytes], state: bytes | None, done: int, last: bool) -> bytes:
    """The state after ``pieces`` or, with ``last``, the digest; ``done`` bytes led to ``state``."""
    context = _Context()
    lib.MD5_Init(ctypes.byref(context))
    if state is not None:
        context.words[:] = struct.unpack("<4I", state)
        context.low, context.high = (done << 3) & 0xFFFFFFFF, (done >> 29) & 0xFFFFFFFF
    for piece in pieces:
        lib.MD5_Update(ctypes.byref(context), piece, len(piece))
    if last:
        out = ctypes.create_string_buffer(16)
        lib.MD5_Final(out, ctypes.byref(context))
        return out.raw
    if context.num:
        raise ValueError(f"a state is handed on at multiples of {BLOCK} bytes")
    return struct.pack("<4I", *context.words)


@cache
def _library():
    """OpenSSL as hashlib loads it; None where it has no MD5 functions or they give another digest."""
    try:
        import _hashlib
        lib = ctypes.CDLL(_hashlib.__file__)
        for name, kinds in (("MD5_Init", [ctypes.c_void_p]), ("MD5_Final", [ctypes.c_void_p, ctypes.c_void_p]),
                            ("MD5_Update", [ctypes.c_void_p, ctypes.c_char_p, ctypes.c_size_t])):
            getattr(lib, name).argtypes = kinds
    except (ImportError, AttributeError, OSError):
        return None
    sample = bytes(range(200))
    state = _carry(lib, [sample[:128]], None, 0, False)
    same = _carry(lib, [sample[128:]], state, 128, True) == hashlib.md5(sample, usedforsecurity=False).digest()
    return lib if same else None


def can_carry() -> bool:
    return _library() is not None


def carry_md5(pieces: Iterable[bytes], state: bytes | None, done: int, last: bool) -> bytes:
    """Go on from ``state`` (None at the start) over ``pieces``: the next state (16 bytes), or the digest if ``last``.

    ``done`` is the number of bytes before ``pieces``; without ``last`` it and the bytes of ``pieces`` are multiples
    of ``BLOCK``.
    """
    return _carry(_library(), pieces, state, done, last)

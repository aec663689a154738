"""Pieces of DuckDB SQL for the operators' reference queries."""

from __future__ import annotations


def _half_bytes() -> list[int]:
    """CRC-32 of the sixteen half bytes (reflected polynomial 0xEDB88320)."""
    out = []
    for c in range(16):
        for _ in range(4):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        out.append(c)
    return out


def crc32_sql(text: str) -> str:
    """CRC-32 of a string's UTF-8 bytes, half byte by half byte, the lower one first."""
    return f"""xor(4294967295, list_reduce(
    list_transform(range(0, length(hex({text}))), lambda i: ('0x' || hex({text})[i + 2 - 2 * (i % 2)])::BIGINT),
    lambda c, n: xor({_half_bytes()}[(xor(c, n) & 15) + 1]::BIGINT, c >> 4), 4294967295::BIGINT))"""

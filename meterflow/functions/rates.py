"""Tariffs (I11). Doubles, never decimal literals: Spark's decimal division
would round 1/60 to six digits."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Rates:
    # Fixed values of the tariff: 49 ZAR per GiB of data, 1 ZAR per minute
    # of voice, and 1 ZAR = 1 WAK.
    data_per_byte: float = 49.0 / 1073741824.0
    voice_per_second: float = 1.0 / 60.0
    wak_per_zar: float = 1.0


RATES = Rates()

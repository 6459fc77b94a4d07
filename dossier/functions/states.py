"""State-code dictionary and the state decoder (P-3 / F-6)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from dossier.functions.text import col, strip

# --- fixed values that must equal the reference ------------------------------
# Lower-case two-letter code -> state name (the decoder's whole dictionary).
STATES = {
    "al": "Alabama", "ak": "Alaska", "az": "Arizona", "ar": "Arkansas",
    "ca": "California", "co": "Colorado", "ct": "Connecticut", "de": "Delaware",
    "fl": "Florida", "ga": "Georgia", "hi": "Hawaii", "id": "Idaho",
    "il": "Illinois", "in": "Indiana", "ia": "Iowa", "ks": "Kansas",
    "ky": "Kentucky", "la": "Louisiana", "me": "Maine", "md": "Maryland",
    "ma": "Massachusetts", "mi": "Michigan", "mn": "Minnesota", "ms": "Mississippi",
    "mo": "Missouri", "mt": "Montana", "ne": "Nebraska", "nv": "Nevada",
    "nh": "New Hampshire", "nj": "New Jersey", "nm": "New Mexico", "ny": "New York",
    "nc": "North Carolina", "nd": "North Dakota", "oh": "Ohio", "ok": "Oklahoma",
    "or": "Oregon", "pa": "Pennsylvania", "ri": "Rhode Island", "sc": "South Carolina",
    "sd": "South Dakota", "tn": "Tennessee", "tx": "Texas", "ut": "Utah",
    "vt": "Vermont", "va": "Virginia", "wa": "Washington", "wv": "West Virginia",
    "wi": "Wisconsin", "wy": "Wyoming",
}
# --- end of fixed values -------------------------------------------------------


def states_map() -> Column:
    """The dictionary as a map literal: 50 entries, folded into the plan as a
    constant, so the lookup needs neither a join nor a broadcast."""
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(STATES.items())])


def decode_state(sab) -> Column:
    """Strip, then map a known lower-case code to its name; anything else
    (unknown codes, upper-case codes) passes through stripped; null stays null."""
    code = strip(col(sab))
    return F.coalesce(F.try_element_at(states_map(), code), code)

"""Workers give memory back between batches."""

import re
import subprocess
import sys

import pytest

HELD = """
import re
import numpy as np, pyarrow as pa
from caesura.llm.tokens import default_path, encoder, slices

def held():
    return int(re.search(r"RssAnon:\\s+(\\d+)", open("/proc/self/status").read())[1]) / 1024

own = encoder(default_path("byte_bpe_50k.json"))
before = held()
rng = np.random.RandomState(5)
letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz" + b" " * 6, np.uint8)
for _ in range(6):
    made = letters[rng.randint(0, len(letters), 4_000_000)].tobytes().decode()
    texts = pa.array([made[i : i + 2_000] for i in range(0, len(made), 2_000)])
    del made
    for i, j in slices(texts):
        own.encode(texts.slice(i, j - i))
own.forget()
print(held() - before)
"""


@pytest.mark.skipif(not sys.platform.startswith("linux"), reason="reads /proc")
def test_what_an_encoder_is_done_with_goes_back():
    out = subprocess.run([sys.executable, "-c", HELD], capture_output=True, text=True, check=True, timeout=120).stdout
    assert float(re.search(r"\S+", out)[0]) < 100

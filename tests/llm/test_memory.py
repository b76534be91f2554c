"""Python workers return what they freed, as they live on through later stages."""

import os

import pyarrow as pa

from cratelake.llm import packing, text


def _resident():
    with open("/proc/self/statm") as file:
        return int(file.read().split()[1]) * os.sysconf("SC_PAGE_SIZE")


def test_freed_memory_goes_back_to_the_system():
    text.give_back()
    before = _resident()
    held = [bytes(1000) for _ in range(200_000)] + [pa.array(range(1_000_000))]
    assert _resident() > before + 150_000_000
    del held
    text.give_back()
    assert _resident() < before + 100_000_000


def test_packing_and_slices_give_memory_back_in_their_tasks():
    for task in (packing.tokenized, packing.pack, text.map_slices):
        assert any("give_back" in c.co_names for c in task.__code__.co_consts if hasattr(c, "co_names"))

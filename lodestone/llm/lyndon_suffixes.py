"""Suffix arrays of many short texts at once, by linear grouping.

Every text is a list of strings; its suffixes are those of its strings, each
read to its own end (an end sorts before every character).  The construction
has two phases.  The first sorts suffixes into groups by their Lyndon prefix: groups
start as the first characters and are taken in descending order; every member
points to its previous smaller suffix (the nearest one before it whose group is
lower), and the suffixes pointed to move into new groups right behind their old
one, apart by how many pointers they got.  The second phase walks the growing suffix
array in ascending order; each suffix taken emits, along the pointers, the
suffixes whose Lyndon prefix ends where it starts into the next places of their groups.
No names are assigned to substrings and nothing recurses.

All texts run in step, one group (then one suffix) of every text at a time, so each
step is a handful of whole-array operations; the work is linear in the total length.
"""

from __future__ import annotations

import numpy as np

from lodestone.llm.arrays import ragged


def suffix_orders(data: np.ndarray, starts: np.ndarray, lens: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, base): positions in ``data`` (relative to a layout in which the
    strings stand one after another) of all suffixes, text by text, sorted
    within each text; suffixes of text t are order[base[t]:base[t + 1]].

    ``text`` is the ascending text number of each string, from 0 on; strings
    are not empty.  Position p of the layout is the p-th character of all
    strings taken in order.
    """
    n = int(lens.sum())
    texts = int(text[-1]) + 1 if len(text) else 0
    chars = data[ragged(starts, lens)]
    first = np.cumsum(lens) - lens  # layout position of each string
    per_text = np.bincount(text, weights=lens, minlength=texts).astype(np.int64)
    base = np.concatenate([[0], np.cumsum(per_text)])
    owner = np.repeat(np.arange(texts), per_text)

    # positions are shifted by one, so 0 and every string start's predecessor mean "none"
    prev = np.arange(-1, n - 1)
    prev[first] = -1
    done = np.zeros(n + 1, dtype=bool)  # done[-1] stands for "none": never done

    key = owner * 256 + chars
    slot_pos = np.argsort(key, kind="stable")
    pos_slot = np.empty(n, dtype=np.int64)
    pos_slot[slot_pos] = np.arange(n)
    sorted_key = key[slot_pos]
    head = np.flatnonzero(np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])) if n else np.zeros(0, np.int64)
    size = np.zeros(n, dtype=np.int64)
    size[head] = np.diff(np.append(head, n))
    group = np.empty(n, dtype=np.int64)  # first slot of a position's group
    group[slot_pos] = np.repeat(head, size[head])
    del key, sorted_key

    # phase 1: groups in descending order
    top = base[1:].copy()
    moving = np.zeros(n, dtype=bool)
    live = np.flatnonzero(top > base[:-1])
    while len(live):
        t = top[live]
        g = group[slot_pos[t - 1]]
        members = slot_pos[ragged(g, t - g)]
        top[live] = g
        live = live[g > base[live]]
        done[members] = True
        p = prev[members]
        late = np.flatnonzero(done[p])
        while len(late):  # over suffixes of this and of higher groups
            p[late] = prev[p[late]]
            late = late[done[p[late]]]
        prev[members] = p
        q = np.sort(p[p >= 0])
        if not len(q):
            continue
        new = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]]))
        u, count = q[new], np.diff(np.append(new, len(q)))
        old = group[u]
        o = np.argsort(old * (int(count.max()) + 1) + count, kind="stable")
        u, count, old = u[o], count[o], old[o]
        at = np.flatnonzero(np.concatenate([[True], old[1:] != old[:-1]]))
        moved = np.diff(np.append(at, len(u)))
        end = old[at] + size[old[at]]
        tail = ragged(end - moved, moved)
        # members that stay but stand in the tail change places with movers that do not
        moving[u] = True
        here = slot_pos[tail]
        stay = here[~moving[here]]
        if len(stay):
            was = pos_slot[u]
            hole = was[was < np.repeat(end - moved, moved)]
            slot_pos[hole] = stay
            pos_slot[stay] = hole
        moving[u] = False
        slot_pos[tail] = u
        pos_slot[u] = tail
        split = np.flatnonzero(np.concatenate([[True], (old[1:] != old[:-1]) | (count[1:] != count[:-1])]))
        width = np.diff(np.append(split, len(u)))
        size[old[at]] -= moved
        size[tail[split]] = width
        group[u] = np.repeat(tail[split], width)
    del slot_pos, pos_slot, size, moving, done

    # phase 2: each group's order, in ascending order of what follows its Lyndon prefix
    order = np.full(n, -1, dtype=np.int64)
    filled = np.zeros(n, dtype=np.int64)
    placed = np.zeros(n + 1, dtype=bool)
    placed[-1] = True  # "none" ends every chain

    def emit(p: np.ndarray) -> None:
        p = p[~placed[p]]
        while len(p):
            g = group[p]
            order[g + filled[g]] = p
            filled[g] += 1
            placed[p] = True
            p = prev[p]
            p = p[~placed[p]]

    # the ends of strings sort first: one string of every text at a time
    nth = np.arange(len(text)) - np.searchsorted(text, text)
    by = np.argsort(nth, kind="stable")
    cut = np.searchsorted(nth[by], np.arange(int(nth.max()) + 2)) if len(by) else np.zeros(1, np.int64)
    last = first + lens - 1
    for a, b in zip(cut[:-1], cut[1:]):
        emit(last[by[a:b]])
    before = np.arange(-1, n - 1)
    before[first] = -1
    by_size = np.argsort(-per_text, kind="stable")
    alive = np.searchsorted(-per_text[by_size], -np.arange(int(per_text.max(initial=0))), side="left")
    start = base[:-1][by_size]
    for k in range(len(alive)):
        emit(before[order[start[:alive[k]] + k]])
    return order, base

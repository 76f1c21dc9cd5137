"""Small invented observation files."""

from pathlib import Path


def line(time, e=1.0, n=2.0, u=3.0, q=1, ns=9, sd=0.001, day="2024/03/01"):
    tail = " ".join(str(sd) for _ in range(6))
    return f"{day} {time}  {e} {n} {u}  {q} {ns} {tail} 0.5 3.0"


def write_pos(root, baseline, stamp, lines, ending="0000b.pos"):
    folder = Path(root) / baseline
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / f"{baseline}{stamp}{ending}"
    path.write_text("".join(f"{text}\n" for text in lines))
    return str(path)

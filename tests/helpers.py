"""Small schedule files for tests."""

from pathlib import Path

from slotmill import fixed


def schedule_row(**fields):
    return "\t".join(fields.get(name, "") for name in fixed.PRELOG_COLUMNS)


def write_drop(root, folder, name, lines, newline="\n"):
    path = Path(root) / folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(line + newline for line in lines), encoding="utf-8", newline="")
    return str(path)


def programme(number, **fields):
    values = {
        "CHANNEL_ID": "5",
        "TX_DATE": "20240223",
        "START_TIME": "0600",
        "SLOT_DURATION": "30",
        "MAIN_TITLE": f"Programme {number}",
        "PROGRAMME_ID": f"{number:06d}",
        "LOADING_FACTOR": "1",
    }
    return schedule_row(**{**values, **fields})

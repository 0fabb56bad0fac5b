"""What counts as a word: a run of anything but the six ASCII white-space characters."""

WORD = r"[^\x20\x09-\x0D]+"

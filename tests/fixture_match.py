"""The hand-made match report (invented names); trailing blanks matter."""

from datetime import datetime

from matchbook.schemas import RAW_LINES

STARS, DASHES = "*" * 60, "-" * 60


def _absent(name):
    return name.ljust(16)


MATCH = [
    "Alders v Birches",
    "English FC League - D1 - 1 May 2026",
    STARS,
    "Alders - 1st Innings                              R    B   4s   6s",
    DASHES,
    "A Ash           c V'oncelos b Stone         40   70    5    -",
    "B Oak           lbw b Stone                 10   20    1    -",
    "C Elm           c & b Stone                  0    2    -    -",
    "D Fir           not out                     30   41    2    1",
    "E Yew           run out                      7    9    -    -",
    "F Curran        st Vale b Reed              12   15    1    -",
    "G Curran        b Reed                       1    4    -    -",
    "H Pine          not out                      5    6    -    -",
    _absent("I Box"),
    _absent("J Ivy"),
    _absent("K Bay"),
    DASHES,
    "Extras: (lb 2, nb 1)                            8",
    "TOTAL: (6 wkts dec, 27.5 overs)                      113",
    STARS,
    "                   O   M    R   W   Econ",
    DASHES,
    "S Stone          14.0   2   60   3   4.29",
    "T Reed           13.5   1   50   2   3.61",
    "",
    "Fall of Wickets:",
    "1-20   2-21   3-21   4-60   5-80",
    "6-100",
    STARS,
    "Birches - 1st Innings                              R    B   4s   6s",
    DASHES,
    "R Vasconcelos   c Curran b Elm              25   40    3    -",
    "S Stone         b Elm                        0    1    -    -",
    "T Reed          not out                     20   33    1    -",
    "U Vale          rtrd hurt                    9   12    -    -",
    "V Moss          not out                      4    5    -    -",
    _absent("W Fern"),
    DASHES,
    "Extras: (lb 2, nb 1)                            3",
    "TOTAL: (2 wkts, 15.1 overs)                      61",
    STARS,
    "                   O   M    R   W   Econ",
    DASHES,
    "C Elm             8.0   0   30   2   3.75",
    "H Pine            7.1   1   28   0   3.91",
    "",
    "Fall of Wickets:",
    "1-1   2-40",
    STARS,
    "Alders won by an innings and 52 runs",
    "Man of the match: A Ash",
]


def raw_lines(spark, files):
    """Raw line table of {file name: lines}."""
    at = datetime(2026, 9, 1)
    rows = [(line, name, i, at) for name, lines in files.items() for i, line in enumerate(lines, 1)]
    return spark.createDataFrame(rows, RAW_LINES)

"""Plain model of the counts of a text, line by line."""

import re

from foliospark.llm.quality import COMMON

WORD = re.compile(r"[^\W_]+")
ITEM = re.compile(r"\s*(?:[•◦▪‣·∙●○*+–—-]|\(?(?:\d{1,3}|[A-Za-z]|[ivxIVX]{1,5})[.)])\s")
GAP = re.compile(r"(?<=\S)(?:\s{3,}|\s*\t\s*)(?=\S)")


def counts(text):
    out = [0] * 11
    for line in text.split("\n"):
        words, shown = WORD.findall(line), "".join(line.split())
        common, chars = sum(w.lower() in COMMON for w in words), sum(map(len, words))
        for i, n in enumerate((len(line), len(shown), len(words), chars, common)):
            out[i] += n
        if not shown:
            continue
        ends, opening = shown[-1] in ".!?…:;。！？\"”)", line.lstrip()
        out[5] += 1
        out[6] += ends
        bars, gaps, commas = line.count("|"), len(GAP.findall(line)), line.count(",") + line.count(";")
        spread = commas >= 2 and common <= len(words) * 0.15 and not ends
        short = len(shown) <= 48
        if bars >= 2 or gaps >= 2 or (gaps == 1 and short) or (spread and chars <= 2.7 * len(words)):
            kind = 8
        elif ITEM.match(opening) or (spread and words and chars >= 0.7 * len(shown)) or (
            short and not ends and shown[-1] not in ",-\xac\xad" and 0 < len(
                words
            ) <= 9 and chars >= 0.7 * len(shown) and not opening[0].islower()
        ):
            kind = 7
        else:
            kind = 9 if (common >= max(1, len(words) * 0.08) or short and words) and chars >= 0.6 * len(shown) else 10
        out[kind] += len(shown)
    return out

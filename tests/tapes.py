"""Hand-written tapes: lines by field name, everything else empty or a good value."""

from loantape.catalogue import column_names

GOOD = {
    "lnId": "100000000001", "month": "012010", "channel": "R", "seller": "Bank A",
    "servicer": "Servicer ONE", "rate": "4.5", "curRate": "4.5", "opb": "200000", "upb": "199000",
    "term": "360", "origDt": "112009", "fpDt": "012010", "age": "2", "rTermLgl": "358",
    "rTermAct": "357", "matDt": "122039", "ltv": "80", "cltv": "85", "numBorr": "2", "dti": "35",
    "fico": "740", "coFico": "720", "firstTime": "N", "purpose": "P", "propType": "SF",
    "units": "1", "occ": "P", "state": "CA", "msa": "31080", "zip3": "900", "mi": "25",
    "amType": "FRM", "pPen": "N", "io": "N", "dqStat": "00", "mod": "N", "servAct": "N",
    "relo": "N", "sConform": "N", "hltv": "N",
}


def line(width=108, **values):
    row = {**GOOD, **values}
    return "|".join(row.get(name, "") for name in column_names(width))


def write(folder, name, lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")
    return str(folder / name)

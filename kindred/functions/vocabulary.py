"""Word tables of the rich normaliser."""

# Results depend on each entry. Spelling on the left, form kept on the right.
NAME_WORDS = {
    "pvt": "private",
    "private": "private",
    "ltd": "limited",
    "limited": "limited",
    "inc": "inc",
    "incorporated": "inc",
    "corp": "corp",
    "corporation": "corp",
    "co": "co",
    "coy": "co",
    "company": "co",
    "llc": "llc",
    "llp": "llp",
    "lp": "lp",
    "plc": "plc",
    "intl": "international",
    "natl": "national",
    "tech": "technology",
    "assoc": "associates",
    "bros": "brothers",
    "engg": "engineering",
    "grp": "group",
    "hosp": "hospital",
    "inds": "industries",
    "mgmt": "management",
    "pharma": "pharmaceuticals",
    "sys": "systems",
    "univ": "university",
    "ent": "enterprise",
    "ents": "enterprise",
    "hldgs": "holdings",
}

# Words that carry the legal form and not the name.
LEGAL_WORDS = [
    "private", "limited", "inc", "corp", "co", "llc", "llp", "lp", "plc",
    "company", "corporation",
]

# Postal words and the short form kept.
ADDRESS_WORDS = {
    "street": "st",
    "str": "st",
    "road": "rd",
    "avenue": "av",
    "ave": "av",
    "boulevard": "bd",
    "blvd": "bd",
    "lane": "ln",
    "drive": "dr",
    "drv": "dr",
    "court": "ct",
    "place": "pl",
    "plaza": "plz",
    "square": "sq",
    "terrace": "ter",
    "circle": "cir",
    "highway": "hwy",
    "parkway": "pkwy",
    "expressway": "expy",
    "freeway": "fwy",
    "trail": "trl",
    "route": "rte",
    "suite": "ste",
    "apartment": "apt",
    "appt": "apt",
    "floor": "fl",
    "building": "bldg",
    "room": "rm",
    "north": "n",
    "south": "s",
    "east": "e",
    "west": "w",
    "northeast": "ne",
    "northwest": "nw",
    "southeast": "se",
    "southwest": "sw",
}

"""Problem 1: free-entered values mapped to the entries of a canonical list.

Prefix-filtered set-similarity join. Distinct values and the labels of the list are cut into word-padded
character bigrams, bigrams are ordered by global rarity, only rare prefixes are joined, length and positional
filters prune the pairs, Jaccard is verified exactly on the survivors, their words are compared one by one and the
best label is kept.
Labels are the entries, spellings that rules derive from them, and the fixed short forms below.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegrain.functions.text import clean, is_blank
from sitegrain.sources.tables import table

# Customary short forms of states that no rule below derives, by postal code.
STATE_SHORT = {
    "AL": "ala", "AK": "alas", "AZ": "ariz", "AR": "ark", "CA": "calif;cali;cal", "CO": "colo;col", "CT": "conn",
    "DE": "del;dela", "DC": "washington dc;wash dc;dist of columbia;d of c", "FL": "fla;flor", "GA": "geo", "HI": "haw", "ID": "ida",
    "IL": "ill;ills", "IN": "ind", "IA": "ioa", "KS": "kan;kans", "KY": "ken;kent", "LA": "lou", "ME": "mne",
    "MD": "mary", "MA": "mass", "MI": "mich", "MN": "minn", "MS": "miss", "MO": "mizz", "MT": "mont", "NE": "neb;nebr",
    "NV": "nev", "OH": "ohi", "OK": "okla", "OR": "ore;oreg", "PA": "penn;penna", "PR": "pto rico;p rico",
    "TN": "tenn", "TX": "tex", "UT": "utah", "VT": "verm", "VA": "virg", "WA": "wash", "WI": "wis;wisc", "WY": "wyo",
    "NM": "n mex;nmex;new mex", "NC": "n car;ncar;no car", "SC": "s car;scar;so car", "ND": "n dak;ndak;no dak", "SD": "s dak;sdak;so dak", "WV": "w va;wva;w virg", "RI": "rhode is;rhode isl;r is",
}
# Other names that people use for a specialty, by the entry's name.
SPECIALTY_OTHER = {
    "Cardiology": "cardio;heart care;heart vascular;heart and vascular;heart;cardiac care;cardiovascular;cardiovascular medicine;heart disease",
    "Dermatology": "derm;skin care;skin health;skin;skin disease;dermatologic care",
    "Endocrinology": "endo;hormone disorders;diabetes endocrine;diabetes and endocrine;diabetes;hormones;thyroid care",
    "Gastroenterology": "gi;gastro;digestive health;digestive care;digestive disease",
    "Oncology/Hematology": "heme onc;hem onc;onc heme;cancer care;oncologist hematologist;hematology oncology;oncology;hematology;cancer;blood cancer;onc",
    "Neurology": "neuro;brain nerve care;brain and nerve care;nerve care;neurologic care",
    "Psychiatry": "psych;psychiatric care;mental illness",
    "Pulmonology": "pulm;lung care;pulmonary medicine;pulmonary;lung health;lung disease;respiratory care;chest medicine",
    "Rheumatology": "rheum;arthritis care;joint care;arthritis",
    "Nephrology": "renal medicine;kidney care;renal;kidney disease;renal care;neph;kidney health",
    "Urology": "uro;urologic care;urologic",
    "OB-GYN/Fertility": "ob gyn;obgyn;obstetrics and gynecology;obstetrics gynecology;fertility;gynecology;obstetrics;ob gyn and fertility;fertility care;reproductive medicine;reproductive health",
    "Pediatrics": "peds;paediatrics;childrens health;child health;pediatric care;kids care",
    "Ophthalmology": "ophtho;eye care;eye surgery;eye health;eyes;ophth",
    "Orthopedics": "ortho;orthopaedics;bone and joint;bone joint;orthopedic surgery;bones and joints",
    "Pain Management": "pain mgmt;pain clinic;pain medicine;pain care;pain;pain relief",
    "Allergy/Immunology": "allergy and immunology;allergy;immunology;allergies;allergist immunologist;asthma allergy;allergy asthma;allergist",
    "Infectious Disease": "id;infectious dz;infections;infectious diseases;infection",
    "Family Medicine": "family practice;fam med;family med;family doctor;fm;family health",
    "Internal Medicine": "im;internist;int med;internal med;general internal medicine",
    "Primary Care": "pcp;primary care physician;primary",
    "Urgent Care": "walk in care;walk in;walk in clinic;uc;immediate care",
    "Plastic Surgery": "plastics;cosmetic surgery;plastic and cosmetic surgery;aesthetic surgery",
    "General Surgery": "gen surg;surgery;gen surgery",
    "Vascular Surgery": "vasc surg;vein surgery;vascular;vein care;vascular surg",
    "Bariatrics": "bariatric medicine;weight loss surgery;bariatric surgery;weight loss;obesity medicine",
    "Sleep Medicine": "sleep;sleep disorders;sleep med;sleep care",
    "Radiology": "diagnostic imaging;imaging;xray;medical imaging;rads;x ray",
    "Pathology": "path;lab medicine;lab pathology;laboratory medicine",
    "Anesthesiology": "anesthesia;anaesthesia;anaesthesiology;anes;anesth",
    "Otolaryngology": "ent;ear nose throat;ear nose and throat;oto",
    "Podiatry": "foot care;foot and ankle;foot ankle care;foot and ankle care;feet;foot health",
    "Geriatrics": "senior care;elder care;geriatric medicine;aging care;senior health;elderly care",
    "Hepatology": "liver disease;liver care;liver;hep;liver health",
    "Vaccines": "immunizations;vaccinations;immunization;shots;vaccine studies;vaccination",
    "Addiction Medicine": "addiction;substance abuse;substance use;addiction med;recovery medicine;substance use disorders",
    "Physical Therapy": "pt;physiotherapy;physical rehab;phys therapy;physio;rehab",
    "Dentistry": "dental;dental care;dentist;teeth;oral health",
    "Wound Care": "wounds;wound healing;wound",
    "Women's Health": "women;womens care;female health",
    "Men's Health": "men;mens care;male health",
    "Behavioral Health": "behavioural health;mental health;behavioral;behavioral medicine;bh",
    "Genetics": "medical genetics;genetic medicine;genetic counseling;genomics",
    "Transplant Medicine": "transplants;organ transplant;transplant;transplant surgery;transplantation",
    "Sports Medicine": "sports med;sport medicine;sports injuries;sports;athletic medicine",
    "Emergency Medicine": "er;emerg med;em;emergency;emergency room;emergency care;emergency med",
    "Neurosurgery": "neuro surgery;brain surgery;neurosurg;spine surgery;brain and spine surgery",
    "Palliative Care": "palliative;hospice;hospice care;hospice palliative;hospice and palliative;hospice and palliative care;comfort care;palliative medicine;end of life care",
    "Occupational Health": "occ health;occupational med;occupational medicine;occ med;work health;workplace health;employee health",
    "Multispecialty": "multi specialty;multiple specialties;multi specialty group;all specialties;many specialties",
}
# Words that add nothing to a state or a specialty.
NOISE = "state|commonwealth|of|the|us|usa|u s a|dept|department|adult|services|service|clinic|clinics|center|centre|division|program|office"
ENDINGS = (("ology", "ologist"), ("iatry", "iatrist"), ("iatrics", "iatrician"), ("istry", "ist"), ("edics", "edist"), ("surgery", "surgeon"), ("iatrics", "iatric"), ("netics", "neticist"))
SCHEMA = "field_name string, value string, canon_key string"


def norm(value: Column) -> Column:
    """Lower-case words: dots and apostrophes vanish, other marks part words, noise words go (unless nothing would stay)."""
    flat = F.regexp_replace(F.lower(F.coalesce(value, F.lit(""))), "[.'’`]", "")
    flat = F.trim(F.regexp_replace(F.regexp_replace(flat, r"[^\p{L}\p{N}]+", " "), r"(?<=.{6}) \d+$", " "))
    bare = F.trim(F.regexp_replace(F.regexp_replace(flat, rf"\b({NOISE})\b", " "), " +", " "))
    return F.when(bare == "", flat).otherwise(bare)


def bigrams(text: Column) -> Column:
    """The distinct character pairs of the words, each word padded at both ends."""
    padded = F.concat(F.lit("^"), F.regexp_replace(text, " +", "\\$ ^"), F.lit("$"))
    return F.array_distinct(F.regexp_extract_all(padded, F.lit("(?=([^ ]{2}))"), 1))


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(field_name, label, canon_key, fuzzy) for both lists; fuzzy is 2 for entries, 1 for other names, 0 for short forms.

    The result is as large as the lists times their spellings.
    """
    states = table(spark, sf_dir, "state_ref")
    code, name = F.col("state_code"), F.lower("state_name")
    short = F.create_map(*[F.lit(x) for k, v in STATE_SHORT.items() for x in (k, v)])
    first, rest = F.element_at(F.split(name, " "), 1), F.regexp_replace(name, "^[^ ]+ ", "")
    lead = lambda words, put: F.when(first.isin(*words), F.concat_ws(" ", F.lit(put), rest))
    initial = F.when(name.contains(" ") & first.isin("new", "north", "south", "west", "puerto", "rhode"), F.concat_ws(" ", F.substring(first, 1, 1), rest))
    exact = F.flatten(F.array(F.array(F.lower(code), F.concat_ws(" ", name, F.lower(code)), initial, lead(("north",), "no"), lead(("south",), "so")), F.split(F.coalesce(F.try_element_at(short, code), F.lit("")), ";")))
    of_state = states.select(F.lit("address_state").alias("field_name"), code.alias("canon_key"), F.explode(F.array(F.struct(F.array(name).alias("l"), F.lit(2).alias("fuzzy")), F.struct(exact.alias("l"), F.lit(0).alias("fuzzy")))).alias("x"))
    ref = table(spark, sf_dir, "specialty_ref")
    entry = F.lower("canonical_name")
    other = F.create_map(*[F.lit(x) for k, v in SPECIALTY_OTHER.items() for x in (k, v)])
    made = [F.when(entry.contains(a), F.replace(entry, F.lit(a), F.lit(b))) for a, b in ENDINGS]
    names = F.array_compact(F.array(entry, *made))
    others = F.split(F.coalesce(F.try_element_at(other, F.col("canonical_name")), F.lit("")), ";")
    of_spec = ref.select(F.lit("specialties").alias("field_name"), F.col("canonical_name").alias("canon_key"), F.explode(F.array(F.struct(names.alias("l"), F.lit(2).alias("fuzzy")), F.struct(others.alias("l"), F.lit(1).alias("fuzzy")))).alias("x"))
    flat = of_state.unionByName(of_spec).select("field_name", "canon_key", F.explode("x.l").alias("label"), "x.fuzzy")
    flat = flat.withColumn("label", norm(F.col("label"))).where("label <> ''")
    return flat.groupBy("field_name", "label").agg(F.min("canon_key").alias("canon_key"), F.max("fuzzy").alias("fuzzy"))


def set_similarity_join(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """Pairs (lid, rid, jaccard) of equal ``part`` whose sets have a Jaccard similarity of at least ``threshold``.

    ``left`` and ``right`` hold ``part``, a unique id (``lid`` / ``rid``) and ``toks`` (distinct strings). Null or
    empty sets match nothing; repeated ids are the caller's to remove. No pair is lost: with tokens ordered by
    rarity, sets at or above the threshold share a token within the first n - ceil(t * n) + 1 of both.
    """

    def exploded(df: DataFrame, key: str) -> DataFrame:
        return df.select("part", F.col(key).alias("id"), F.lit(key).alias("side"), F.explode("toks").alias("tok"))

    long = exploded(left, "lid").unionByName(exploded(right, "rid"))
    freq = long.groupBy("part", "tok").agg(F.count("*").alias("df"))
    ranked = long.join(freq, ["part", "tok"]).groupBy("side", "part", "id").agg(F.transform(F.array_sort(F.collect_list(F.struct("df", "tok"))), lambda x: x["tok"]).alias("toks"))
    n = F.size("toks")
    keep = n - F.ceil(F.lit(threshold) * n).cast("int") + 1
    prefix = ranked.select("*", n.alias("n"), F.posexplode(F.slice("toks", F.lit(1), keep)).alias("pos", "tok"))
    a = prefix.where("side = 'lid'").select("part", "tok", F.col("id").alias("lid"), F.col("n").alias("ln"), F.col("pos").alias("lp"), F.col("toks").alias("lt"))
    b = prefix.where("side = 'rid'").select("part", "tok", F.col("id").alias("rid"), F.col("n").alias("rn"), F.col("pos").alias("rp"), F.col("toks").alias("rt"))
    pairs = a.join(b, ["part", "tok"])
    least, most = F.least("ln", "rn"), F.greatest("ln", "rn")
    need = F.lit(threshold / (1 + threshold)) * (F.col("ln") + F.col("rn"))
    room = 1 + F.least(F.col("ln") - F.col("lp"), F.col("rn") - F.col("rp")) - 1 + F.least("lp", "rp")
    pairs = pairs.where((least >= most * threshold - 1e-9) & (room >= need - 1e-9)).dropDuplicates(["part", "lid", "rid"])
    both = F.size(F.array_intersect("lt", "rt"))
    jaccard = both / (F.col("ln") + F.col("rn") - both)
    return pairs.select("part", "lid", "rid", jaccard.alias("jaccard")).where(F.col("jaccard") >= threshold - 1e-9)


def edit_distance(a: str, b: str) -> int:
    """Insertions, deletions, replacements and swaps of neighbours, letters lost or put between these included."""
    far = len(a) + len(b)
    d = {(-1, j): far for j in range(-1, len(b) + 1)} | {(i, -1): far for i in range(len(a) + 1)}
    d |= {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    seen: dict[str, int] = {}
    for i, x in enumerate(a, 1):
        same = 0
        for j, y in enumerate(b, 1):
            k, m = seen.get(y, 0), same
            if x == y:
                same = j
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (x != y), d[k - 1, m - 1] + i - k + j - m - 1)
        seen[x] = i
    return d[len(a), len(b)]


def word_edits(a: str, b: str) -> int | None:
    """Edits that turn the typed word into the entry's word, null if they are too many for a slip of typing.

    One edit is allowed from four letters on. Two are from five letters on, if the first letter stays and the word is
    not merely cut short by them, since words with another start or ending (virology, audiology, India) are other words.
    """
    if a == b:
        return 0
    if len(b) < 4 or len(a) < 3 or abs(len(a) - len(b)) > 2:
        return None
    d = edit_distance(a, b)
    return d if d == 1 or (d == 2 and len(b) >= 5 and a[0] == b[0] and not b.startswith(a)) else None


def word_agreement(a: str, b: str) -> float:
    """The part of the letters in which two texts agree if each word of one fits a word of the other in any order, else 0.

    ``and`` is no word. Beside a word that fits wholly, one may be cut short to four letters or more. Since a slip may hit
    a short word or a space, texts of several words also fit if they do so as one word, with or without their spaces.
    """
    x, y = ([w for w in t.split(" ") if w != "and"] for t in (a, b))
    if sorted(x) == sorted(y):
        return 1.0
    longer = max(len("".join(x)), len("".join(y)))
    whole = set(x) & set(y)
    fits = [d for gap in ("", " ") if (d := word_edits(gap.join(x), gap.join(y))) is not None]
    for order in (permutations(y) if len(y) <= 5 else [y]) if len(x) == len(y) else []:
        each = [1 if whole and len(v) >= 4 and w.startswith(v) and v != w else word_edits(v, w) for v, w in zip(x, order, strict=True)]
        if None not in each:
            fits.append(sum(each))
    return max(0.0, 1 - min(fits) / longer) if fits else 0.0


def canonicalize(values: DataFrame, label_rows: DataFrame, join_at: float = 0.2, same_other: float = 0.85) -> DataFrame:
    """(field_name, value, canon_key) for distinct ``values`` (field_name, value); canon_key is '' where no entry fits.

    A label fits when it equals the normalised value or, unless it is a short form or has under four letters, when
    the two agree word by word (``word_agreement``); other names than the entry's own must agree in ``same_other`` of
    their letters. Of several the best agreement wins, then the higher Jaccard, then the smaller key. Null or blank
    values get ''.
    """
    v = values.select("field_name", "value", norm(F.col("value")).alias("text"))
    texts = v.select(F.col("field_name").alias("part"), F.col("text").alias("lid")).where("lid <> ''").distinct().withColumn("toks", bigrams(F.col("lid")))
    right = label_rows.select(F.col("field_name").alias("part"), F.col("label").alias("rid"), bigrams(F.col("label")).alias("toks"))
    found = set_similarity_join(texts, right, join_at)
    found = found.join(label_rows.select(F.col("field_name").alias("part"), F.col("label").alias("rid"), "canon_key", "fuzzy"), ["part", "rid"])

    def agree(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            p["same"] = p.lid == p.rid
            p["agree"] = [word_agreement(a, b) for a, b in zip(p.lid, p.rid, strict=True)]
            yield p[["part", "lid", "canon_key", "fuzzy", "jaccard", "agree", "same", "rid"]]

    scored = found.mapInPandas(agree, "part string, lid string, canon_key string, fuzzy int, jaccard double, agree double, same boolean, rid string")
    loose = (F.length("rid") >= 4) & (F.length("lid") >= 3)
    near = ((F.col("fuzzy") == 2) & (F.col("agree") > 0)) | ((F.col("fuzzy") == 1) & (F.col("agree") >= same_other))
    fits = F.col("same") | (loose & near)
    best = scored.where(fits).groupBy("part", "lid").agg(F.min_by("canon_key", F.struct(~F.col("same"), -F.col("agree"), -F.col("jaccard"), F.col("canon_key"))).alias("canon_key"))
    out = v.join(best, (v.field_name == best.part) & (v.text == best.lid), "left")
    return out.select("field_name", "value", F.coalesce("canon_key", F.lit("")).alias("canon_key"))


def typed_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(field_name, ord, pos, value): every non-blank state and every non-blank list item that is not an entry as it stands."""
    loc = table(spark, sf_dir, "locations").select(F.lit("address_state").alias("field_name"), "ord", F.lit(0).alias("pos"), clean("address_state").alias("value"))
    rows = table(spark, sf_dir, "classified_rows").select("ord", F.posexplode(F.split("specialties", ";")).alias("pos", "item"))
    items = rows.select(F.lit("specialties").alias("field_name"), "ord", "pos", clean("item").alias("value"))
    entries = table(spark, sf_dir, "state_ref").select(F.lit("address_state").alias("field_name"), F.col("state_code").alias("value"))
    entries = entries.unionByName(table(spark, sf_dir, "specialty_ref").select(F.lit("specialties").alias("field_name"), F.col("canonical_name").alias("value")))
    return loc.unionByName(items).where("value <> ''").join(entries, ["field_name", "value"], "left_anti")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed states and specialties with the entry that is meant ('' where none is)."""
    typed = typed_values(spark, sf_dir)
    mapped = canonicalize(typed.select("field_name", "value").distinct(), labels(spark, sf_dir))
    return typed.join(mapped, ["field_name", "value"]).select("field_name", F.col("ord").cast("long").alias("ord"), F.col("pos").cast("int").alias("pos"), "canon_key")


def p1_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of values that fit no entry, with the number of their uses."""
    typed = typed_values(spark, sf_dir).groupBy("field_name", "value").agg(F.count("*").alias("n_uses"))
    mapped = canonicalize(typed.select("field_name", "value"), labels(spark, sf_dir))
    return typed.join(mapped.where("canon_key = ''"), ["field_name", "value"]).select("field_name", "value", "n_uses")

"""The drug vocabulary: record filters, brands, nested dosages, casing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from . import relational as R

# --- Fixed values: substances and forms ------------------------------------------------------------------------------
EXCLUDED_BEGINNINGS = ("STREPTOCOCCUS", "VIBRIO", "TEINTURE", "TARTRATE", "SULPHATE", "SULFATE", "SUCCINATE", "SEL ", "VIRUS", "HUILE", "EXTRAIT", "EXTRACTION", "PHOSPHATE", "PEROXYDE", "CHLORHYDRATE", "PROTÉINE", "POLYOSIDE", "OLIGOSIDE", "MÉSILATE", "MALÉATE", "INSULINE")
EXCLUDED_ENDS = ("INACTIVÉ",)
EXCLUDED_PARTS = ("NATUROPA", "SOLUTION", "(", ")", "[", "]")
EXCLUDED_PATTERNS = ("HOM[EÉ]OPATHIQUE", r"^\S+ATE\s+D")
EXCLUDED_WHOLE = ("OR", "URÉE")
ALLOWED_FORMS = ("capsule", "collyre", "comprimé", "gélule", "microgranule gastro-résistant en gélule", "microsphère et solution pour usage parentéral ou à libération prolongée", "ovule", "suppositoire")


def excluded(substance: Column) -> Column:
    """Whether a substance is left out: by its beginning, end, a part, a pattern or as a whole, in capitals."""
    s = F.upper(F.trim(substance))
    quoted = lambda xs: "|".join(rf"\Q{x}\E" for x in xs)
    return s.isin(*EXCLUDED_WHOLE) | s.rlike(f"^({quoted(EXCLUDED_BEGINNINGS)})") | s.rlike(f"({quoted(EXCLUDED_ENDS)})$") | s.rlike(f"{quoted(EXCLUDED_PARTS)}|{'|'.join(EXCLUDED_PATTERNS)}")


def clean_form(form: Column) -> Column:
    return C.squeeze(F.regexp_replace(form, r"\([^)]*\)", " "))


def active_records(records: DataFrame) -> DataFrame:
    """Records that are authorised and sold, in an allowed form (cleaned), with no component that is excluded, in
    solution or a derivative. Derivatives are names of several words in any record's composition."""
    names = records.select(F.explode("composition.denominationSubstance").alias("s")).where(F.size(F.split(F.trim("s"), r"\s+")) > 1)
    derived = names.select(F.upper(F.trim("s")).alias("name")).distinct()
    form = clean_form(F.col("formePharmaceutique"))
    allowed = F.lower(form).rlike("|".join(rf"\Q{f}\E" for f in ALLOWED_FORMS))
    bad = F.exists("composition", lambda c: F.coalesce(excluded(c["denominationSubstance"]), F.lit(False)) | F.coalesce(F.contains(F.lower(c["elementPharmaceutique"]), F.lit("solution")), F.lit(False)))
    fine = records.where((F.lower("statusAutorisation") == "autorisation active") & (F.lower("etatComercialisation") == "commercialisée") & allowed & ~bad)
    parts = fine.select("cis", F.explode("composition.denominationSubstance").alias("s")).select("cis", F.upper(F.trim("s")).alias("name"))
    return fine.withColumn("formePharmaceutique", form).join(parts.join(derived, "name", "left_semi").select("cis").distinct(), "cis", "left_anti")


def index_presentations(records: DataFrame) -> DataFrame:
    """(cip13, drug_name, forme, substances, prix): one row a presentation, codes of 13 digits."""
    rows = records.select("elementPharmaceutique", "formePharmaceutique", "composition", F.posexplode("presentation").alias("_at", "p"))
    return rows.select(F.lpad(F.col("p.cip13").cast("string"), 13, "0").alias("cip13"), F.col("elementPharmaceutique").alias("drug_name"), F.col("formePharmaceutique").alias("forme"), F.array_join(F.array_distinct("composition.denominationSubstance"), "|").alias("substances"), F.col("p.prix").cast("string").alias("prix"), "_at")


def by_brand(sales: DataFrame, name: str, substances: str, volume: str, vocabulary: DataFrame) -> DataFrame:
    """(brand, substances, volume): brands that hold no word of the vocabulary, with the union of their substances."""
    brands = sales.select(C.brand(F.col(name)).alias("brand"), F.split(substances, r"\|").alias("s"), F.col(volume).alias("v")).where("brand <> ''")
    sums = brands.groupBy("brand").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("s")))).alias("substances"), F.sum("v").alias(volume))
    return R.containment(sums, "brand", vocabulary, "word").where("witness is null").drop("witness")


def molecule_words(names: DataFrame, column: str) -> DataFrame:
    return names.select(F.explode(F.regexp_extract_all(F.upper(column), F.lit(r"(?U)\w+"), 0)).alias("word")).where("char_length(word) > 3").distinct()


def distinct_dosages(doses: Column) -> Column:
    """The head as it is, then dosages in their order, equal values and units once, blanks gone."""
    rest = F.filter(F.transform(F.slice(doses, 2, F.greatest(F.size(doses) - 1, F.lit(0))), lambda d: F.trim(d)), lambda d: d != "")
    key = lambda d: F.coalesce(F.concat_ws(" ", C.dosage(d)["value"].cast("string"), C.dosage(d)["unit"]), d)
    empty = F.array().cast("array<string>")
    kept = F.aggregate(rest, F.struct(empty.alias("keys"), empty.alias("out")), lambda a, d: F.when(F.array_contains(a["keys"], key(d)), a).otherwise(F.struct(F.array_append(a["keys"], key(d)).alias("keys"), F.array_append(a["out"], d).alias("out"))))
    return F.concat(F.slice(doses, 1, 1), kept["out"])


def nested_dosages(rows: DataFrame) -> DataFrame:
    """(substance, forms: map form -> map reference -> sorted dosages) of (substance, form, reference, dosage)."""
    doses = rows.groupBy("substance", "form", "reference").agg(F.array_sort(F.collect_set("dosage")).alias("d"))
    refs = doses.groupBy("substance", "form").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("reference", "d")))).alias("r"))
    return refs.groupBy("substance").agg(F.map_from_entries(F.collect_list(F.struct("form", "r"))).alias("forms"))


def with_dosages(terms: DataFrame, dosages: DataFrame) -> DataFrame:
    """terms with a map from each of their substances to its dosages, by folded names; a term without any has null."""
    key = lambda c: F.upper(F.trim(C.unaccented(F.col(c))))
    known = dosages.groupBy(key("substance").alias("_k")).agg(F.max_by("forms", "substance").alias("_f"))
    each = terms.select("term", F.explode_outer("substances").alias("_s")).withColumn("_k", key("_s")).join(known, "_k")
    nested = each.dropDuplicates(["term", "_s"]).groupBy("term").agg(F.map_from_entries(F.collect_list(F.struct("_s", "_f"))).alias("dosages"))
    return terms.join(nested, "term", "left")


def casing_lexicon(texts: DataFrame, text: str, reference: DataFrame, min_pair: float = 0.3) -> DataFrame:
    """(key, canonical, protected) of reference words (word): how the texts write them outside sentence starts.

    The commonest spelling that is not all capitals wins; a lower-case winner takes the reference's accents, or none
    where the plain spelling has min_pair of its count; words never seen are capitalised. Short words, Roman numerals
    and four letters with fewer than two vowels keep their capitals.
    """
    fold = lambda c: F.upper(C.unaccented(c))
    sentence = F.split(text, r"(?<=[.!?])\s+")
    words = texts.select(F.explode(sentence).alias("s")).select(F.posexplode(F.regexp_extract_all("s", F.lit(r"\p{L}+(?:[-']\p{L}+)*"), 0)).alias("at", "w"))
    seen = words.where((F.col("at") > 0) & F.col("w").rlike(r"\p{Ll}")).groupBy(fold(F.col("w")).alias("key"), F.col("w").alias("form")).agg(F.count("*").alias("n"))
    known = reference.select(fold(F.col("word")).alias("key"), F.lower("word").alias("accented")).groupBy("key").agg(F.min("accented").alias("accented"))
    w = Window.partitionBy("key")
    mine = seen.join(known, "key", "left_semi").withColumn("plain", F.sum(F.when(F.col("form") == F.lower("key"), F.col("n")).otherwise(0)).over(w))
    best = R.keep_one(mine, ["key"], [F.desc("n"), F.col("form")])
    low = F.col("form").rlike(r"^\p{Ll}")
    chosen = F.when(F.col("form").isNull(), F.initcap("accented")).when(low & (F.col("accented") != F.lower("key")), F.col("accented")).when(low & (F.col("plain") >= min_pair * F.col("n")), F.lower("key")).otherwise(F.col("form"))
    vowels = F.char_length(F.regexp_replace("key", "[^AEIOUY]", ""))
    why = F.when(F.char_length("key") < 4, "short").when(F.col("key").rlike("^[IVXLCDM]+$"), "roman").when((F.char_length("key") == 4) & (vowels < 2), "consonants")
    return known.join(best, "key", "left").select("key", chosen.alias("canonical"), why.alias("protected"))

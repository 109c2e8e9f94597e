"""Column functions on DNA strings and codons."""

from __future__ import annotations

from itertools import chain
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, functions as F

# Synonymous codons by amino acid; the order decides ties when recoding.
# Serine lists two of its six codons; the other four are in MORE_SERINE.
SYNONYMS = {
    "A": ["GCT", "GCC", "GCA", "GCG"],
    "R": ["AGA", "AGG", "CGT", "CGC", "CGA", "CGG"],
    "N": ["AAT", "AAC"],
    "D": ["GAT", "GAC"],
    "C": ["TGT", "TGC"],
    "Q": ["CAA", "CAG"],
    "E": ["GAA", "GAG"],
    "G": ["GGT", "GGA", "GGC", "GGG"],
    "H": ["CAT", "CAC"],
    "I": ["ATT", "ATC", "ATA"],
    "L": ["TTA", "TTG", "CTT", "CTC", "CTA", "CTG"],
    "K": ["AAA", "AAG"],
    "M": ["ATG"],
    "F": ["TTT", "TTC"],
    "P": ["CCT", "CCC", "CCA", "CCG"],
    "S": ["AGT", "AGC"],
    "T": ["ACT", "ACC", "ACA", "ACG"],
    "W": ["TGG"],
    "Y": ["TAT", "TAC"],
    "V": ["GTT", "GTC", "GTA", "GTG"],
    "STOP": ["TAA", "TAG", "TGA"],
}
MORE_SERINE = ["TCT", "TCC", "TCA", "TCG"]

# Organisms with a table; their contents are the same.
ORGANISMS = ("human", "mycobacterium")

# Window length in codons, short-oligo limit and melting constants.
WINDOW_CODONS = 8
SHORT_OLIGO = 13


def synonym_table(organism: str = "human", full_serine: bool = False) -> dict[str, list[str]]:
    """Amino acid to codons for an organism; ``full_serine`` gives the standard code."""
    if organism not in ORGANISMS:
        raise ValueError(f"unknown organism {organism!r}")
    if not full_serine:
        return SYNONYMS
    return {**SYNONYMS, "S": SYNONYMS["S"] + MORE_SERINE}


def amino_table(organism: str = "human") -> dict[str, str]:
    """Codon to amino acid, all 64."""
    table = synonym_table(organism, full_serine=True)
    return {codon: amino for amino, codons in table.items() for codon in codons}


def best_synonyms(organism: str = "human", full_serine: bool = False) -> dict[str, tuple[str, int]]:
    """Codon to its most different synonym and the number of changed bases.

    The first of several equally different synonyms wins; a codon without a different
    synonym keeps itself with 0.
    """
    table = synonym_table(organism, full_serine)
    best = {}
    for codon, amino in amino_table(organism).items():
        changed = {other: sum(a != b for a, b in zip(codon, other)) for other in table[amino]}
        top = max(changed, key=changed.get)
        best[codon] = (top, changed[top]) if changed[top] > 0 else (codon, 0)
    return best


def literal_map(table: dict) -> Column:
    return F.create_map(*(F.lit(x) for x in chain.from_iterable(table.items())))


def clean_sequence(seq: Column) -> Column:
    """a-z in upper case, without white space; letters outside ASCII stay as they are."""
    return F.translate(F.regexp_replace(seq, r"\s+", ""), ascii_lowercase, ascii_uppercase)


def codons(seq: Column) -> Column:
    """Array of whole codons, found in one pass; an incomplete tail is dropped."""
    return F.regexp_extract_all(seq, F.lit("(...)"), F.lit(1))


def translate(codon: Column, organism: str = "human") -> Column:
    """Amino acid of a codon; NULL when a letter is none of A, C, G, T."""
    return F.try_element_at(literal_map(amino_table(organism)), codon)


def synonyms(amino: Column, organism: str = "human", full_serine: bool = False) -> Column:
    """Codon array of an amino acid."""
    table = synonym_table(organism, full_serine)
    lists = F.create_map(*chain.from_iterable(
        (F.lit(a), F.array(*(F.lit(c) for c in cs))) for a, cs in table.items()))
    return F.try_element_at(lists, amino)


def best_synonym(codon: Column, organism: str = "human", full_serine: bool = False) -> Column:
    """Most different synonym of a codon."""
    best = best_synonyms(organism, full_serine)
    return F.try_element_at(literal_map({c: new for c, (new, _) in best.items()}), codon)


def changed_bases(a: Column, b: Column, width: int) -> Column:
    """Number of positions, of ``width``, where two strings of that length differ."""
    return sum((F.substring(a, i, 1) != F.substring(b, i, 1)).cast("int")
               for i in range(1, width + 1))


def codon_distance(a: Column, b: Column) -> Column:
    """Number of differing bases of two codons."""
    return changed_bases(a, b, 3)


def base_count(seq: Column, base: str) -> Column:
    return F.length(seq) - F.length(F.replace(seq, F.lit(base), F.lit("")))


def melting_temp(seq: Column, mode: str = "short") -> Column:
    """Melting temperature by base composition.

    ``short`` uses 2 degrees per A/T and 4 per G/C for every length; ``long`` switches to
    the long-oligo formula above 13 bases.
    """
    weak = base_count(seq, "A") + base_count(seq, "T")
    strong = base_count(seq, "G") + base_count(seq, "C")
    short = (weak * 2 + strong * 4).cast("double")
    if mode == "short":
        return short
    if mode == "long":
        long = 64.9 + 41.0 * (strong - F.lit(16.4)) / (weak + strong)
        return F.when(F.length(seq) > SHORT_OLIGO, long).otherwise(short)
    raise ValueError("mode must be 'short' or 'long'")


def percent_changed(new: Column, old: Column, width: int | None = None) -> Column:
    """Share of positions, in percent, where two strings differ; 0 when lengths differ.

    Strings of ``width`` letters, when it is given, are compared by terms; other ones letter by letter.
    """
    flags = F.transform(
        F.when(F.length(old) > 0, F.sequence(F.lit(1), F.length(old))),
        lambda i: (F.substring(new, i, F.lit(1)) != F.substring(old, i, F.lit(1))).cast("int"))
    changed = F.aggregate(flags, F.lit(0), lambda total, flag: total + flag)
    share = F.when(F.length(new) == F.length(old), changed / F.length(old) * 100).otherwise(F.lit(0.0))
    if width is None:
        return share
    known = (F.length(new) == width) & (F.length(old) == width)
    return F.when(known, changed_bases(new, old, width) / width * 100).otherwise(share)

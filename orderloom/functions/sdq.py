"""Store distribution quantities: SDQ03 is a store, SDQ04 its quantity, and so on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderloom.functions.texts import objects, once, safe_int

# Keys are SDQ and a number; from 3 on, odd ones are stores.
SDQ_KEY = "^SDQ[0-9]+$"
STORE_KEY = "^SDQ(0*[1-9][0-9]*[13579]|0*[3579])$"
LEADING_NUMBERS = ["", "1", "2"]
# The original pairing reads keys of two digits; 99 has no partner.
TWO_DIGIT_STORE = "^SDQ(0[3579]|[1-8][13579]|9[1357])$"
# Nearly all keys are among these; they are looked up, only others meet a pattern.
TWO_DIGITS = [f"SDQ{n:02d}" for n in range(100)]
STORES = TWO_DIGITS[3::2]
# Where the quantity of such a store nearly always is; other keys are worked out.
QUANTITY_KEYS = dict(zip(TWO_DIGITS[3:98:2], TWO_DIGITS[4:99:2]))

MAPS = "array<map<string,string>>"


def segments(text: Column) -> Column:
    """Segment maps in document order; a lone object is one segment.

    A segment that is not an object is NULL and keeps its place.
    """
    return objects(text, "map<string,string>")


def _digits(key: Column) -> Column:
    return F.substring(key, 4, 1 << 30)


def _number(key: Column) -> Column:
    """The number of a key as text without leading zeros, whatever its length."""
    return F.ltrim(_digits(key), F.lit("0"))


def _used(key: Column) -> Column:
    return key.rlike(SDQ_KEY) & ~_number(key).isin(LEADING_NUMBERS)


def _is_store(key: Column, pattern: str = STORE_KEY, stores: list[str] = STORES) -> Column:
    """Whether the key has the pattern, whose keys of two digits are ``stores``."""
    return (
        F.when(key.isin(stores), True)
        .when(key.isin(TWO_DIGITS), False)
        .otherwise(key.rlike(pattern))
    )


def _following(number: Column) -> Column:
    """The next whole number, as text."""
    stem = F.regexp_replace(number, "9+$", "")
    carried = F.repeat(F.lit("0"), F.length(number) - F.length(stem))
    last = F.coalesce(F.right(stem, F.lit(1)).try_cast("int"), F.lit(0))
    longer = F.concat(
        F.left(stem, F.length(stem) - 1), (last + 1).cast("string"), carried
    )
    return F.when(F.length(number) < 10, (number.cast("int") + 1).cast("string")).otherwise(longer)


def _each_segment(maps: Column, build) -> Column:
    built = F.transform(maps, lambda m, i: build(m, i))
    return F.flatten(F.filter(built, lambda part: part.isNotNull()))


def entries(maps: Column) -> Column:
    """Every used key as (segment, index, value); the index is NULL beyond the int range."""

    def build(m: Column, i: Column) -> Column:
        return F.transform(
            F.filter(F.map_keys(m), _used),
            lambda k: F.struct(
                i.alias("segment"),
                _number(k).try_cast("int").alias("index"),
                F.try_element_at(m, k).alias("value"),
            ),
        )

    return _each_segment(maps, build)


def _usual(key: Column) -> Column:
    """The key with the next number, written with as many digits."""
    digits = F.length(key) - 3
    short = F.lpad((_digits(key).cast("int") + 1).cast("string"), digits, "0")
    longer = once(
        _following(_number(key)), lambda n: F.lpad(n, F.greatest(digits, F.length(n)), "0")
    )
    carries = key.endswith("9") | (digits > 8)
    return F.concat(F.lit("SDQ"), F.when(carries, longer).otherwise(short))


def _partner(m: Column, usual: Column) -> Column:
    """The key with the number of ``usual``: that key, or else any spelling of it."""

    def other(number: Column) -> Column:
        spelled = F.filter(
            F.map_keys(m),
            lambda k: k.startswith("SDQ") & k.endswith(number) & (_number(k) == number),
        )
        return F.get(spelled, F.lit(0))

    held = F.try_element_at(m, usual).isNotNull() | F.map_contains_key(m, usual)
    return F.when(held, usual).otherwise(once(_number(usual), other))


def _pair(i: Column, store: Column, qty: Column) -> Column:
    return F.struct(i.alias("segment"), store.alias("store_number"), qty.alias("qty"))


def _store_pairs(maps: Column) -> Column:
    """(key of the quantity, pair) of every store."""

    def build(m: Column, i: Column) -> Column:
        partnered = F.transform(
            F.filter(F.map_keys(m), lambda k: _is_store(k)),
            lambda k: F.struct(
                k.alias("store"), once(_usual(k), lambda u: _partner(m, u)).alias("qty")
            ),
        )
        return F.transform(
            partnered,
            lambda x: F.struct(
                x["qty"].alias("found"),
                _pair(
                    i,
                    F.try_element_at(m, x["store"]),
                    safe_int(F.try_element_at(m, x["qty"])),
                ).alias("pair"),
            ),
        )

    return _each_segment(maps, build)


def pairs(maps: Column) -> Column:
    """Stores with the quantity under the next key of the same segment.

    A store whose next key is missing is left out; a quantity that is not a
    whole number stays as NULL.
    """
    partnered = F.filter(_store_pairs(maps), lambda x: x["found"].isNotNull())
    return F.transform(partnered, lambda x: x["pair"])


def _quantity_key(store: Column) -> Column:
    """The next key of a store key of two digits, from a table; NULL for any other key."""
    listed = F.create_map(*[F.lit(text) for pair in QUANTITY_KEYS.items() for text in pair])
    return F.try_element_at(listed, store)


def positive_pairs(maps: Column) -> Column:
    """The pairs with a quantity above zero; a missing one drops by itself.

    Only a store whose quantity is not under the key of the table has its key worked out.
    """

    def build(m: Column, i: Column) -> Column:
        def quantity(key: Column) -> Column:
            found = once(_usual(key), lambda u: _partner(m, u))
            return F.coalesce(
                F.try_element_at(m, _quantity_key(key)), F.try_element_at(m, found)
            )

        read = F.transform(
            F.filter(F.map_keys(m), lambda k: _is_store(k)),
            lambda k: _pair(i, F.try_element_at(m, k), safe_int(quantity(k))),
        )
        return F.filter(read, lambda x: x["qty"] > 0)

    return _each_segment(maps, build)


def repeated_numbers(maps: Column) -> Column:
    """Whether a segment spells the number of a used key in two ways."""

    def twice(m: Column) -> Column:
        def fewer(numbers: Column) -> Column:
            return F.size(F.array_distinct(numbers)) < F.size(numbers)

        # Keys of two digits alone have a number each.
        odd = F.exists(F.map_keys(m), lambda k: ~k.isin(TWO_DIGITS))
        numbers = F.transform(F.filter(F.map_keys(m), _used), _number)
        return odd & once(numbers, fewer)

    return F.coalesce(F.exists(maps, twice), F.lit(False))


def matched_pairs(maps: Column, partners: Column, summed: bool) -> Column:
    """Pairs of the original joins: a store meets the quantities of all ``partners``.

    ``partners`` are the segment maps of the lines that share the line's pairing
    key, itself included; segments pair by position, keys have two digits.
    Quantities that are equal come as one pair with their count as ``copies``,
    or all as one pair with their sum. Only positive ones count.
    """

    def build(m: Column, i: Column) -> Column:
        def of_store(key: Column) -> Column:
            worked_out = F.concat(
                F.lit("SDQ"),
                F.lpad((F.substring(key, 4, 2).cast("int") + 1).cast("string"), 2, "0"),
            )

            def quantities(name: Column) -> Column:
                read = F.transform(partners, lambda p: safe_int(F.try_element_at(F.get(p, i), name)))
                return F.filter(read, lambda q: q > 0)

            return F.struct(
                F.try_element_at(m, key).alias("store"),
                once(F.coalesce(_quantity_key(key), worked_out), quantities).alias("quantities"),
            )

        def total(x: Column) -> Column:
            added = F.aggregate(x["quantities"], F.lit(0).cast("long"), lambda t, q: t + q)
            return _pair(i, x["store"], added)

        def counted(x: Column, q: Column, copies: Column) -> Column:
            return F.struct(
                i.alias("segment"),
                x["store"].alias("store_number"),
                q.alias("qty"),
                copies.cast("long").alias("copies"),
            )

        def each(x: Column) -> Column:
            # Mostly a store meets one quantity, that of its own line.
            lone = F.array(counted(x, F.get(x["quantities"], F.lit(0)), F.lit(1)))
            told = F.transform(
                F.array_distinct(x["quantities"]),
                lambda q: counted(x, q, F.size(F.filter(x["quantities"], lambda o: o == q))),
            )
            return F.when(F.size(x["quantities"]) == 1, lone).otherwise(told)

        keys = F.filter(F.map_keys(m), lambda k: _is_store(k, TWO_DIGIT_STORE, STORES[:-1]))
        stores = F.transform(keys, of_store)
        met = F.filter(stores, lambda x: F.size(x["quantities"]) > 0)
        return F.transform(met, total) if summed else F.flatten(F.transform(met, each))

    return _each_segment(maps, build)

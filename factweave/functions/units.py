"""The catalogue of units: metric ones by the rule of prefixes, others listed; values to their dimension's standard unit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Metric prefixes: symbol and factor (fixed values).
PREFIXES = {
    "nano": ("n", 1e-9), "micro": ("µ", 1e-6), "milli": ("m", 1e-3), "centi": ("c", 1e-2), "deci": ("d", 1e-1), "deca": ("da", 1e1),
    "hecto": ("h", 1e2), "kilo": ("k", 1e3), "mega": ("M", 1e6), "giga": ("G", 1e9), "tera": ("T", 1e12),
}
#: dimension, unit, symbol, factor to the standard unit, prefixes in use (fixed values).
METRIC = [
    ("Length", "metre", "m", 1.0, "nano micro milli centi deci deca hecto kilo mega giga"),
    ("Mass", "gram", "g", 1.0, "milli kilo"),
    ("Volume", "litre", "l", 1e-3, "micro milli centi deci hecto kilo mega giga"),
    ("Energy", "joule", "J", 1.0, "kilo"),
    ("Energy", "wattHour", "Wh", 3600.0, "milli kilo mega giga tera"),
    ("Energy", "calorie", "cal", 4.1868, "milli kilo mega"),
    ("Force", "newton", "N", 1.0, "nano milli kilo mega giga"),
    ("Force", "pond", "p", 0.00980665, "milli kilo mega"),
    ("Frequency", "hertz", "Hz", 1.0, "milli kilo mega giga"),
    ("Power", "watt", "W", 1.0, "milli kilo mega giga"),
    ("Pressure", "pascal", "Pa", 1.0, "milli hecto kilo mega"),
    ("Pressure", "bar", "bar", 1e5, "milli deci"),
    ("InformationUnit", "byte", "B", 1.0, "kilo mega giga tera"),
]
#: Prefixes of squares and cubes of the metre (fixed values).
POWERS = [("Area", "square", 2, "²", "milli centi deci deca hecto kilo"), ("Volume", "cubic", 3, "³", "milli centi deci deca hecto kilo")]
#: dimension, unit, factor, offset, labels: value * factor + offset is in the standard unit (fixed values).
OTHER = [
    ("Length", "inch", 0.0254, 0.0, "in|inch|inches"), ("Length", "hand", 0.1016, 0.0, "hand"), ("Length", "foot", 0.3048, 0.0, "ft|feet|foot"),
    ("Length", "yard", 0.9144, 0.0, "yd|yard"), ("Length", "fathom", 1.8288, 0.0, "fathom"), ("Length", "rod", 5.0292, 0.0, "rd|perch|pole|rod"),
    ("Length", "chain", 20.1168, 0.0, "chain"), ("Length", "furlong", 201.168, 0.0, "furlong"), ("Length", "mile", 1609.344, 0.0, "mi|miles|mile"),
    ("Length", "nauticalMile", 1852.01, 0.0, "nmi|nautical mile"), ("Length", "astronomicalUnit", 149597870691.0, 0.0, "AU|astronomical unit"),
    ("Length", "lightYear", 9460730472580800.0, 0.0, "ly|light-year"), ("Length", "kilolightYear", 9.4607304725808e18, 0.0, "kly|kilolight-year"),
    ("Mass", "tonne", 1e6, 0.0, "t|tonne"), ("Mass", "stone", 6350.29318, 0.0, "st|stone"), ("Mass", "pound", 453.6, 0.0, "lb|lbs|lbm|pound"),
    ("Mass", "ounce", 28.35, 0.0, "oz|ounce"), ("Mass", "grain", 0.0648, 0.0, "gr|grain"), ("Mass", "carat", 0.2, 0.0, "carat"),
    ("Area", "hectare", 1e4, 0.0, "ha|hectare"), ("Area", "squareInch", 0.00064516, 0.0, "sqin|square inch"), ("Area", "squareFoot", 0.09290304, 0.0, "sqft|ft2|ft²|square foot"),
    ("Area", "squareYard", 0.83612736, 0.0, "sqyd|square yard"), ("Area", "acre", 4046.564224, 0.0, "acre|acres"), ("Area", "squareMile", 2589988.110336, 0.0, "sqmi|mi2|mi²|square mile"),
    ("Area", "squareNauticalMile", 3429904.0, 0.0, "sqnmi|nmi2|square nautical mile"),
    ("Volume", "cubicMile", 4168181825.4406, 0.0, "cumi|mi3|mi³|cubic mile"), ("Volume", "cubicYard", 0.764692, 0.0, "cuyd|yd3|cubic yard"), ("Volume", "cubicFoot", 0.0283219, 0.0, "cuft|ft3|ft³|cubic foot"),
    ("Volume", "cubicInch", 1.639e-5, 0.0, "cuin|in3|in³|cubic inch"), ("Volume", "imperialBarrel", 0.163659, 0.0, "impbl|imperial barrel"), ("Volume", "usBarrel", 0.11924, 0.0, "usbl|us barrel"),
    ("Volume", "imperialBarrelOil", 0.159113, 0.0, "impbbl|imperial barrel oil"), ("Volume", "usBarrelOil", 0.158987, 0.0, "usbbl|us barrel oil"),
    ("Volume", "imperialGallon", 0.00454609, 0.0, "impgal|imperial gallon"), ("Volume", "usGallon", 0.00378541178, 0.0, "usgal|USgal|us gallon"),
    ("Density", "kilogramPerCubicMetre", 1.0, 0.0, "kg/m³|kg/m3|kilogram per cubic metre"), ("Density", "kilogramPerLitre", 1000.0, 0.0, "kg/l|kg/L|kilogram per litre"),
    ("Density", "gramPerCubicCentimetre", 1000.0, 0.0, "g/cc|g/cm3|g/cm³|gram per cubic centimetre"), ("Density", "gramPerMillilitre", 1000.0, 0.0, "g/ml|g/mL|gram per millilitre"),
    ("Energy", "erg", 1e-7, 0.0, "erg"), ("Energy", "inchPound", 0.11298482902, 0.0, "inlb|inch-pound"), ("Energy", "footPound", 1.3558179483, 0.0, "ftlb|foot-pound"),
    ("FlowRate", "cubicMetrePerSecond", 1.0, 0.0, "m³/s|cubic metre per second"), ("FlowRate", "cubicFeetPerSecond", 0.028316846593, 0.0, "ft³/s|cuft/s|cubic feet per second"),
    ("FlowRate", "cubicMetrePerYear", 3.1709791983765e-8, 0.0, "m³/y|cubic metre per year"), ("FlowRate", "cubicFeetPerYear", 8.9792131512047e-10, 0.0, "ft³/y|cubic feet per year"),
    ("Force", "tonneForce", 9806.65, 0.0, "tf|t-f|tonne-force"), ("Force", "kilogramForce", 9.80665, 0.0, "kgf|kg-f|kilogram-force"), ("Force", "gramForce", 0.00980665, 0.0, "gf|g-f|gram-force"),
    ("Force", "milligramForce", 9.80665e-6, 0.0, "mgf|mg-f|milligram-force"), ("Force", "poundal", 0.1383, 0.0, "pdl|poundal"),
    ("FuelEfficiency", "kilometresPerLitre", 1.0, 0.0, "km/l|km/L|kilometres per litre"),
    ("InformationUnit", "bit", 0.125, 0.0, "bit"), ("InformationUnit", "kilobit", 128.0, 0.0, "kbit|kilobit"), ("InformationUnit", "megabit", 131072.0, 0.0, "Mbit|megabit"),
    ("LinearMassDensity", "gramPerKilometre", 1.0, 0.0, "g/km"),
    ("PopulationDensity", "inhabitantsPerSquareKilometre", 1.0, 0.0, "PD/sqkm|/sqkm|per square kilometre"), ("PopulationDensity", "inhabitantsPerSquareMile", 1 / 2.589988110336, 0.0, "PD/sqmi|/sqmi|per square mile"),
    ("Power", "horsepower", 745.72218, 0.0, "hp|horsepower"), ("Power", "pferdestaerke", 735.49875, 0.0, "PS|pferdestaerke"), ("Power", "brakeHorsepower", 745.7, 0.0, "bhp|brake horsepower"),
    ("Pressure", "standardAtmosphere", 101325.0, 0.0, "atm|standard atmosphere"), ("Pressure", "poundPerSquareInch", 6894.7572932, 0.0, "psi|pound per square inch"),
    ("Speed", "kilometrePerHour", 1.0, 0.0, "km/h|kmh|kilometre per hour"), ("Speed", "metrePerSecond", 3.6, 0.0, "m/s|metre per second"), ("Speed", "kilometrePerSecond", 3600.0, 0.0, "km/s|kilometre per second"),
    ("Speed", "milePerHour", 1.60934, 0.0, "mph|mi/h|mile per hour"), ("Speed", "footPerSecond", 1.09728, 0.0, "ft/s|foot per second"), ("Speed", "footPerMinute", 0.01829, 0.0, "ft/min|foot per minute"), ("Speed", "knot", 1.852, 0.0, "kn|knot"),
    ("Temperature", "kelvin", 1.0, 0.0, "K|kelvin"), ("Temperature", "degreeCelsius", 1.0, 273.15, "°C|degree celsius|C|Celsius"),
    ("Temperature", "degreeFahrenheit", 5 / 9, 459.67 * 5 / 9, "°F|F|Fahrenheit|degree fahrenheit"), ("Temperature", "degreeRankine", 5 / 9, 0.0, "°R|R|degree rankine"),
    ("Time", "second", 1.0, 0.0, "s|sec|secs|second|seconds"), ("Time", "minute", 60.0, 0.0, "m|min|min.|mins|minute|minutes"), ("Time", "hour", 3600.0, 0.0, "h|hr|hr.|hour|hours|std"), ("Time", "day", 86400.0, 0.0, "d|days|day"),
    ("Torque", "newtonMetre", 1.0, 0.0, "Nm|N.m|N·m|newton metre"), ("Torque", "newtonMillimetre", 0.001, 0.0, "Nmm|newton millimetre"), ("Torque", "newtonCentimetre", 0.01, 0.0, "Ncm|newton centimetre"),
    ("Torque", "poundFoot", 1.3558179483314, 0.0, "ftlb-f|ftlbf|lbft"),
]
#: Common currencies: unit and labels (fixed values); more are passed as a parameter of the same shape.
CURRENCIES = {
    "usDollar": "$|US$|USD|US dollar", "euro": "€|EUR|Euro", "poundSterling": "£|GBP|Pound sterling", "japaneseYen": "¥|JPY|yen", "russianRouble": "RUB|RUR|Russian rouble",
    "swissFranc": "CHF|Swiss franc", "canadianDollar": "CAD|Canadian dollar", "australianDollar": "AUD|Australian dollar", "indianRupee": "INR|Indian rupee", "renminbi": "CNY|Renminbi",
}
#: The other currencies of the international list by code and name (fixed values); ``WORLD_CURRENCIES`` is made from it by rule.
_WORLD = """
    AED United Arab Emirates dirham, AFN Afghan afghani, ALL Albanian lek, AMD Armenian dram, ANG Netherlands Antillean guilder, AOA Angolan kwanza, ARS Argentine peso, AWG Aruban florin, AZN Azerbaijani manat,
    BAM Bosnia and Herzegovina convertible mark, BBD Barbados dollar, BDT Bangladeshi taka, BGN Bulgarian lev, BHD Bahraini dinar, BIF Burundian franc, BMD Bermudian dollar, BND Brunei dollar, BOB Bolivian boliviano, BRL Brazilian real,
    BSD Bahamian dollar, BTN Bhutanese ngultrum, BWP Botswana pula, BYR Belarusian ruble, BZD Belize dollar, CDF Congolese franc, CLP Chilean peso, COP Colombian peso, CRC Costa Rican colon, CUP Cuban peso, CVE Cape Verde escudo,
    CZK Czech koruna, DJF Djibouti franc, DKK Danish krone, DOP Dominican peso, DZD Algerian dinar, EEK Estonian kroon, EGP Egyptian pound, ERN Eritrean nakfa, ETB Ethiopian birr, FJD Fiji dollar, FKP Falkland Islands pound,
    GEL Georgian lari, GHS Ghanaian cedi, GIP Gibraltar pound, GMD Gambian dalasi, GNF Guinea franc, GTQ Guatemalan quetzal, GYD Guyana dollar, HKD Hong Kong dollar, HNL Honduran lempira, HRK Croatian kuna, HTG Haitian gourde,
    HUF Hungarian forint, IDR Indonesian rupiah, ILS Israeli new sheqel, IQD Iraqi dinar, IRR Iranian rial, ISK Icelandic krona, JMD Jamaican dollar, JOD Jordanian dinar, KES Kenyan shilling, KGS Kyrgyzstani som, KHR Cambodian riel,
    KMF Comorian franc, KPW North Korean won, KRW South Korean won, KWD Kuwaiti dinar, KYD Cayman Islands dollar, KZT Kazakhstani tenge, LAK Lao kip, LBP Lebanese pound, LKR Sri Lankan rupee, LRD Liberian dollar, LSL Lesotho loti,
    LTL Lithuanian litas, LVL Latvian lats, LYD Libyan dinar, MAD Moroccan dirham, MDL Moldovan leu, MGA Malagasy ariary, MKD Macedonian denar, MMK Myanma kyat, MNT Mongolian togrog, MOP Macanese pataca, MRO Mauritanian ouguiya,
    MUR Mauritian rupee, MVR Maldivian rufiyaa, MWK Malawian kwacha, MXN Mexican peso, MYR Malaysian ringgit, MZN Mozambican metical, NAD Namibian dollar, NGN Nigerian naira, NIO Nicaraguan cordoba, NOK Norwegian krone,
    NPR Nepalese rupee, NZD New Zealand dollar, OMR Omani rial, PAB Panamanian balboa, PEN Peruvian nuevo sol, PGK Papua New Guinean kina, PHP Philippine peso, PKR Pakistani rupee, PLN Polish zloty, PYG Paraguayan guarani,
    QAR Qatari riyal, RON Romanian leu, RSD Serbian dinar, RWF Rwandan franc, SAR Saudi riyal, SBD Solomon Islands dollar, SCR Seychellois rupee, SDG Sudanese pound, SEK Swedish krona, SGD Singapore dollar, SHP Saint Helena pound,
    SLL Sierra Leonean leone, SOS Somali shilling, SRD Surinamese dollar, STD Sao Tome and Principe dobra, SYP Syrian pound, SZL Swazi lilangeni, THB Thai baht, TJS Tajikistani somoni, TMT Turkmenistani manat, TND Tunisian dinar,
    TOP Tongan paanga, TRY Turkish lira, TTD Trinidad and Tobago dollar, TWD New Taiwan dollar, TZS Tanzanian shilling, UAH Ukrainian hryvnia, UGX Ugandan shilling, UYU Uruguayan peso, UZS Uzbekistani som, VND Vietnamese dong,
    VUV Vanuatu vatu, WST Samoan tala, XAF Central African CFA franc, XCD East Caribbean dollar, XOF West African CFA franc, XPF CFP franc, YER Yemeni rial, ZAR South African rand, ZMK Zambian kwacha, ZWL Zimbabwean dollar
"""
#: unit -> labels of all other currencies, to be passed as ``more`` to ``cascade.money``: the unit is the name in camel case, the labels are code and name.
WORLD_CURRENCIES = {
    "".join(w if k == 0 else w.capitalize() for k, w in enumerate(name.lower().split())): f"{code}|{name}" for code, name in (x.strip().split(" ", 1) for x in _WORLD.replace("\n", " ").split(","))
}
#: Units of which less is more: standard = factor / value (fixed values).
INVERSE = {"litresPerHundredKilometres": ("FuelEfficiency", 100.0, "l/100km|L/100km")}


#: Dimensions whose values are given in another unit than the standard one where a mapping names only the dimension (fixed values).
SHOWN_IN = {"Temperature": "degreeCelsius"}


def _words(unit: str) -> str:
    return "".join(f"-{ch.lower()}" if ch.isupper() else ch for ch in unit)


def _catalogue() -> list[tuple[str, str, float, float, list[str]]]:
    out = []
    for dim, unit, symbol, factor, prefixes in METRIC:
        plural = [unit + "s"] if unit == "metre" else []
        out.append((dim, unit, factor, 0.0, [symbol, _words(unit), *plural]))
        out += [(dim, p + unit, PREFIXES[p][1] * factor, 0.0, [PREFIXES[p][0] + symbol, p + _words(unit), *(p + x for x in plural)]) for p in prefixes.split()]
    for dim, word, power, mark, prefixes in POWERS:
        for p in ["", *prefixes.split()]:
            symbol, factor = PREFIXES[p] if p else ("", 1.0)
            name = (p + "metre").capitalize()
            out.append((dim, word + name, factor**power, 0.0, [f"{symbol}m{power}", f"{symbol}m{mark}", f"{word} {name.lower()}"]))
    return out + [(d, u, f, o, labels.split("|")) for d, u, f, o, labels in OTHER]


_CATALOGUE = _catalogue()
#: unit -> (dimension, factor, offset)
UNITS = {unit: (dim, factor, offset) for dim, unit, factor, offset, _ in _CATALOGUE}


def labels(dimension: str | None = None) -> dict[str, str]:
    """label -> unit; where dimensions share a label the first listed has it, so name the dimension if it is known."""
    found: dict[str, str] = {}
    for dim, unit, _, _, names in _CATALOGUE:
        if dimension in (None, dim):
            for n in names:
                found.setdefault(n, unit)
    for unit, (dim, _, names) in INVERSE.items():
        if dimension in (None, dim):
            for n in names.split("|"):
                found.setdefault(n, unit)
    return found


def literal_map(entries: dict[str, str]) -> Column:
    """A constant map of strings to SQL literals, folded once a plan."""
    return F.expr("map(" + ", ".join(f"'{k}', {v}" for k, v in entries.items()) + ")")


def let(x: Column, f) -> Column:
    """f(x) with x evaluated once, however often f names it: keeps plans of nested readings small."""
    return F.element_at(F.transform(F.array(x), f), 1)


def _facts(unit: Column) -> Column:
    return F.try_element_at(literal_map({k: f"named_struct('f', {f!r}D, 'o', {o!r}D)" for k, (_, f, o) in UNITS.items()}), unit)


def to_standard(value: Column, unit: Column) -> Column:
    """The value in its dimension's standard unit; null for unknown units and for currencies."""
    out = let(_facts(unit), lambda u: value * u["f"] + u["o"])
    for name, (_, factor, _) in INVERSE.items():
        out = F.when((unit == name) & (value != 0), factor / value).otherwise(out)
    return out


def from_standard(value: Column, unit: Column) -> Column:
    """A value of the standard unit in another unit of the dimension."""
    return let(_facts(unit), lambda u: (value - u["o"]) / u["f"])


def dimension(unit: Column) -> Column:
    known = {k: f"'{d}'" for k, (d, _, _) in UNITS.items()} | {k: f"'{d}'" for k, (d, _, _) in INVERSE.items()} | {k: "'Currency'" for k in CURRENCIES}
    return F.try_element_at(literal_map(known), unit)

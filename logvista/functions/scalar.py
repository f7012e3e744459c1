"""Row-wise expressions of the cleaning and identity steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_KM = 6371.0088
#: Spellings that are made one.
COUNTRIES = {"The Netherlands": "Netherlands"}
#: Continents of the countries that a release may hold. What is not listed maps to null.
CONTINENTS = {
    "Africa": ("Algeria Eswatini Comoros Seychelles Angola Benin Botswana Burundi Cameroon Chad Djibouti Egypt Eritrea Ethiopia Gabon Gambia Ghana Guinea Kenya Lesotho Liberia Libya Madagascar Malawi Mali Mauritania "
               "Mauritius Morocco Mozambique Namibia Niger Nigeria Rwanda Senegal Somalia Sudan Tanzania Togo Tunisia Uganda Zambia Zimbabwe,South Africa,Cape Verde,Sierra Leone,Ivory Coast,South Sudan,Central African Republic,"
               "Burkina Faso,Guinea-Bissau,Equatorial Guinea,São Tomé and Príncipe,Democratic Republic of the Congo,Republic of the Congo,Cabo Verde"),
    "Asia": ("Afghanistan Brunei Armenia Azerbaijan Bahrain Bangladesh Bhutan Cambodia China Georgia India Indonesia Iran Iraq Israel Japan Jordan Kazakhstan Kuwait Kyrgyzstan Laos Lebanon Macao Malaysia "
             "Maldives Mongolia Myanmar Nepal Oman Pakistan Palestine Philippines Qatar Singapore Syria Taiwan Tajikistan Thailand Turkmenistan Türkiye Turkey Uzbekistan Vietnam Yemen,"
             "Hong Kong,Saudi Arabia,South Korea,North Korea,Sri Lanka,United Arab Emirates,Timor-Leste"),
    "Europe": ("Albania Andorra Austria Belarus Belgium Bulgaria Croatia Cyprus Czechia Denmark Estonia Finland France Germany Greece Hungary Iceland Ireland Italy Kosovo Latvia Liechtenstein "
               "Lithuania Luxembourg Malta Moldova Monaco Montenegro Netherlands Norway Poland Portugal Romania Russia Serbia Slovakia Slovenia Spain Sweden Switzerland Ukraine,"
               "United Kingdom,North Macedonia,Czech Republic,Vatican City,San Marino,Bosnia and Herzegovina"),
    "North America": ("Bahamas Barbados Belize Canada Cuba Dominica Grenada Guatemala Haiti Honduras Jamaica Mexico Nicaragua Panama,United States,Costa Rica,Dominican Republic,El Salvador,Puerto Rico,"
                      "Trinidad and Tobago,Saint Lucia,Saint Kitts and Nevis,Saint Vincent and the Grenadines,Antigua and Barbuda"),
    "South America": "Argentina Bolivia Brazil Chile Colombia Ecuador Guyana Paraguay Peru Suriname Uruguay Venezuela",
    "Oceania": "Australia Micronesia Fiji Kiribati Nauru Palau Samoa Tonga Tuvalu Vanuatu,New Zealand,Marshall Islands,Papua New Guinea,Solomon Islands",
}
CHALLENGES = ("password", "passkey", "device_prompt", "idv_preregistered_phone", "idv_preregistered_email")


def continent_rows() -> list[tuple[str, str]]:
    out = []
    for continent, names in CONTINENTS.items():
        single, *more = names.split(",")
        out += [(c, continent) for c in [*single.split(), *more]]
    return out


def parse_time(text: Column) -> Column:
    """A UTC timestamp from mixed ISO forms; null if it can't be read."""
    return F.try_to_timestamp(F.trim(text))


def decimal(text: Column) -> Column:
    """A number that may have a decimal comma; null if it is none."""
    return F.replace(F.trim(text), F.lit(","), F.lit(".")).try_cast("double")


def coordinates(lat: Column, lon: Column) -> tuple[Column, Column]:
    """Both null if either is known and out of range; one that is missing leaves the other alone."""
    outside = F.coalesce(~lat.between(-90, 90), F.lit(False)) | F.coalesce(~lon.between(-180, 180), F.lit(False)) | F.isnan(lat) | F.isnan(lon)
    outside = F.coalesce(outside, F.lit(False))
    return F.when(~outside, lat), F.when(~outside, lon)


def country(name: Column) -> Column:
    names = F.create_map(*(F.lit(x) for pair in COUNTRIES.items() for x in pair))
    return F.coalesce(names[name], name)


def with_continent(df: DataFrame, country_col: str = "ip_country", out: str = "continent") -> DataFrame:
    """The continent of each country, by a broadcast look-up in a fixed table; null for null and for unlisted ones."""
    dim = df.sparkSession.createDataFrame(continent_rows(), f"c_country string, `{out}` string")
    return df.drop(out).join(F.broadcast(dim), F.col(country_col) == F.col("c_country"), "left").drop("c_country")


def ip_version(text: Column) -> Column:
    number = text.try_cast("double")
    return F.when(number.isin(4.0, 6.0), number.cast("int"))


def detect_ip_version(address: Column) -> Column:
    """4 or 6 by the form of an address, else null."""
    octet = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
    four = address.rlike(rf"^(?:{octet}\.){{3}}{octet}$")
    groups = r"[0-9A-Fa-f]{1,4}"
    full = rf"^(?:{groups}:){{7}}{groups}$"
    short = rf"^(?=.*::)(?!.*::.*::)(?:(?:{groups}:){{0,6}}{groups})?::(?:(?:{groups}:){{0,6}}{groups})?$"
    return F.when(four, 4).when(address.rlike(full) | address.rlike(short), 6)


def signal(text: Column) -> Column:
    """1 for true, 1, yes; 0 for false, 0, no, in any case; null for anything else, which the caller has to refuse."""
    low = F.lower(F.trim(text))
    return F.when(low.isin("true", "1", "yes"), 1).when(low.isin("false", "0", "no"), 0)


def tokens(text: Column) -> Column:
    """Distinct trimmed pieces between bars, in first order; null if there are none."""
    parts = F.array_distinct(F.filter(F.transform(F.split(text, r"\|"), lambda x: F.trim(x)), lambda x: x != ""))
    return F.when(F.size(parts) > 0, parts)


def pipe_dedupe(text: Column) -> Column:
    return F.array_join(tokens(text), "|")


def event_status(name: Column) -> Column:
    """What an event name says about the outcome of the login."""
    known = {"login_success": "success", "login_failure": "failure", "login_challenge": "challenge", "login_verification": "verification"}
    out = F.when(F.lit(False), "")
    for k, v in known.items():
        out = out.when(name == k, v)
    return out.otherwise("other")


def calendar(time: Column) -> dict[str, Column]:
    """The UTC hour a time falls in, and its parts; Monday is day 0."""
    hour = F.date_trunc("hour", time)
    return {"event_time_hour_utc": hour, "event_hour": F.hour(hour), "day_of_week": F.weekday(hour), "month": F.month(hour), "is_weekend": (F.weekday(hour) >= 5).cast("int")}


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle kilometres; null unless all four are known and in range."""
    valid = lat1.between(-90, 90) & lat2.between(-90, 90) & lon1.between(-180, 180) & lon2.between(-180, 180)
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.when(valid, F.lit(2 * EARTH_KM) * F.asin(F.least(F.lit(1.0), F.sqrt(a))))


def challenge_flags(text: Column) -> dict[str, Column]:
    """Substring flags and the number of distinct pieces; null counts as empty."""
    full = F.coalesce(text, F.lit(""))
    out = {f"uses_{c}": full.contains(c).cast("int") for c in CHALLENGES}
    return out | {"num_challenge_methods": F.when(full == "", 0).otherwise(F.size(F.array_distinct(F.split(full, r"\|"))))}


def profile(prior: Column) -> Column:
    return F.when(prior == 0, "0").when(prior < 10, "1-9").when(prior >= 10, ">=10")


def known_history(since_last: Column) -> Column:
    """The earliest form of the history flag: 1 after some time since the previous login, 0 without one or at the same instant.

    The time must be unrounded: rounded hours are 0 for less than 0.18 seconds.
    """
    return F.coalesce((since_last > 0).cast("int"), F.lit(0))


def geo_jump(country_changed: Column, continent_changed: Column) -> Column:
    """Changes of country and continent together, 0 to 2."""
    return country_changed + continent_changed


def min_max(x: Column, low: Column, high: Column) -> Column:
    """Scaled to [0, 1] by a range found elsewhere, clipped."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), (x - low) / (high - low + F.lit(1e-9))))

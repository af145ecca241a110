"""Fixed table shapes, field lists and enumerations."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: instrument columns and the longest text each may hold (None = unbounded) ------
INSTRUMENT_LENGTHS: dict[str, int | None] = {
    "symbol": 255, "exchange_code": 50, "description": None, "security_type": 50,
    "gross_net": 10, "price_indicator": 50, "expiration_date": 50, "display_date": 50,
    "put_call": 10, "strike_price": 50, "option_root": 50, "session": 50, "trade_units": 50,
    "currency": 10, "lot_units": 50, "conversion_factor": 50, "underlier": 255,
    "alternate_symbol": 255, "alt_exchange": 50, "prev_settle_date": 50, "settle_date": 50,
    "datecreated": 50, "display_date2": 50, "rowguid": 50, "conversion_code": 50,
    "source_symbol": 255, "curve_period": 50, "forward_period": 50, "category": 50,
    "model_code": 50, "marketbasis": 200, "product": 50, "commodity": 50, "supplier": 50,
    "startdate": 50, "enddate": 50, "fidgroup": 50, "rownum": 50,
}
INSTRUMENT_COLUMNS = list(INSTRUMENT_LENGTHS)
INSTRUMENT_KEY = ["symbol", "exchange_code", "security_type", "option_root", "source_symbol"]
INSTRUMENT_AUDIT = ["created_at", "updated_at", "last_seen_date", "last_price_pull_date"]
INSTRUMENT_SENTINELS = ["nan", "None", "<NA>", "NaT"]

# --- fixed values: price columns -----------------------------------------------------------------
PRICE_TEXT_LENGTHS: dict[str, int] = {
    "pricesymbol": 255, "symbol": 255, "symboldescription": 500, "currency": 10,
    "lasttradedirection": 10, "putcallunderlier": 50, "optionroot": 100,
    "displaycontractexpdate": 50, "market": 100, "lotunit": 50, "exchangecode": 50,
}
PRICE_TEXT = list(PRICE_TEXT_LENGTHS)
PRICE_TIMES = [
    "tradedatetimeutc", "closedate", "settledate", "mostrecentvaluedate", "biddatetimeutc",
    "askdatetimeutc", "expirationdate", "tradestarttimeutc", "tradestoptimeutc",
    "sessionstarttimeutc", "sessionstoptimeutc", "blocktradedatetimeutc", "settleupdatetime",
    "prevsettleupdatetime",
]
PRICE_COUNTS = ["tickcount"]
PRICE_NUMBERS = [
    "open", "high", "low", "close", "last", "midpoint", "volume", "tradevolume",
    "historicvolume", "netchange", "percentchange", "openinterest", "mostrecentvalue",
    "prevlast", "lastopen", "lasthigh", "lastlow", "lastclose", "lastvolume", "bid", "ask",
    "bidsize", "asksize", "strike",
]
# Those of the numbers that are prices, and so change with the currency and the unit.
PRICE_VALUES = ["open", "high", "low", "close", "last", "midpoint", "mostrecentvalue", "prevlast",
                "lastopen", "lasthigh", "lastlow", "lastclose", "bid", "ask", "strike"]
PRICE_KEY = ["symbol", "tradedatetimeutc", "pricesymbol"]
PRICE_AUDIT = ["created_at", "updated_at", "data_source"]
PRICE_SENTINELS = ["nan", "None", "NaN", ""]
DATA_SOURCE = "MV_API"
QUOTE_FIELDS = [
    "pricesymbol", "symboldescription", "tradedatetimeutc", "open", "high", "low", "close",
    "last", "midpoint", "volume", "tradevolume", "historicvolume", "tickcount", "netchange",
    "percentchange", "openinterest", "closedate", "currency", "mostrecentvalue",
    "mostrecentvaluedate", "lasttradedirection", "prevlast", "lastopen", "lasthigh", "lastlow",
    "lastclose", "lastvolume", "putcallunderlier", "bid", "ask", "bidsize", "asksize",
    "biddatetimeutc", "askdatetimeutc", "optionroot", "settledate", "displaycontractexpdate",
    "market", "expirationdate", "lotunit", "strike", "tradestarttimeutc", "tradestoptimeutc",
    "sessionstarttimeutc", "sessionstoptimeutc", "blocktradedatetimeutc", "settleupdatetime",
    "prevsettleupdatetime", "exchangecode",
]
PRICE_COLUMNS = ["symbol", *QUOTE_FIELDS]

# --- fixed values: named projections -------------------------------------------------------------
FIELD_PRESETS: dict[str, list[str]] = {
    "QUOTE_ALL": QUOTE_FIELDS,
    "STANDARD": ["pricesymbol", "tradedatetimeutc", "open", "high", "low", "last", "volume",
                 "openinterest"],
    "STANDARDWITHSETTLEDATE": ["pricesymbol", "tradedatetimeutc", "open", "high", "low", "last",
                               "volume", "openinterest", "settledate"],
    "ALL": ["pricesymbol", "tradedatetimeutc", "open", "high", "low", "close", "volume",
            "midpoint", "openinterest"],
    "INTRADAY": ["pricesymbol", "tradedatetimeutc", "open", "high", "low", "close", "volume"],
    "CURVE": ["symbol", "description", "curveroot", "curvedate", "displaydate"],
}

# --- fixed values: enumerations ------------------------------------------------------------------
FREQUENCIES = {1: "days", 2: "weeks", 3: "months", 4: "contract_months", 5: "quarters",
               6: "years", 7: "intraday"}
FILL_METHODS = ["forward", "backward", "average", "interpolate", "projected", "nofill"]
FILL_CALENDARS = ["business", "sixdays", "sevendays"]
AGGREGATE_TYPES = {0: "daily", 1: "peak", 2: "offpeak"}
CURVE_VALUES = {0: "price", 1: "spread", 2: "spreadpercent", 3: "relative", 4: "relativepercent",
                5: "spreadwave", 6: "spreadpercentwave", 7: "spread100percentwave",
                8: "spreadavg"}
LEAD_LAG_TYPES = {0: "calendardays", 1: "quoteddays", 2: "weeks"}
UNITS = ["BBL", "LTR", "KLTR", "CM", "GAL", "MSCF", "MT", "ST", "MMB", "THM", "GJ", "GWH", "KWH",
         "MWH"]
CURRENCIES = ["USD", "USC", "GBP", "GBC", "EUR", "EUC", "JPY", "CNV", "CHF", "SGD", "CAD", "CAC",
              "AUD", "NZD", "MYR", "HKD", "KRW", "THB", "DKK", "NOK", "SEK", "TWD", "ZAR", "BRL",
              "MXN", "BHD", "SAR", "RUB", "ARS"]
MINOR_CURRENCIES = {"USC": "USD", "GBC": "GBP", "EUC": "EUR", "CAC": "CAD"}
RATE_SOURCES = ["BCB", "BNM", "BNZ", "BOC", "BOE", "BOI", "BOJ", "BOM", "BOT", "DNB", "ECB",
                "FXZ", "IMF", "RBA", "USF"]
MONTH_CODES = "FGHJKMNQUVXZ"
SECURITY_TYPES = ["fo", "f"]


def text_schema(columns: list[str], corrupt: str | None = None) -> T.StructType:
    """All-text read schema: inference would change key values such as ``001`` or ``NA``."""
    fields = [T.StructField(c, T.StringType()) for c in columns]
    if corrupt:
        fields.append(T.StructField(corrupt, T.StringType()))
    return T.StructType(fields)


def price_type(column: str) -> T.DataType:
    if column in PRICE_TIMES or column in ("created_at", "updated_at"):
        return T.TimestampType()
    if column in PRICE_COUNTS:
        return T.LongType()
    return T.DoubleType() if column in PRICE_NUMBERS else T.StringType()


PRICE_TABLE = T.StructType(
    [T.StructField(c, price_type(c)) for c in [*PRICE_COLUMNS, "price_hash", *PRICE_AUDIT]]
)
INSTRUMENT_TABLE = T.StructType(
    [T.StructField(c, T.StringType()) for c in [*INSTRUMENT_COLUMNS, "instrument_hash"]]
    + [
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
        T.StructField("last_seen_date", T.DateType()),
        T.StructField("last_price_pull_date", T.DateType()),
    ]
)
SERIES_TABLE = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("field", T.StringType()),
        T.StructField("ondate", T.DateType()),
        T.StructField("index", T.TimestampType()),
        T.StructField("value", T.DoubleType()),
    ]
)
METADATA_TABLE = text_schema(["symbol", "property", "value"])

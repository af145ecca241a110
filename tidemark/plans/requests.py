"""The request functions, over stored tables instead of a remote service.

Each function checks its arguments first, then returns one lazy DataFrame; Catalyst sees filter,
window and projection together. What a request computes where only its name and arguments are known
is this library's own definition (README, "Definitions").
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import (
    bars,
    calendars,
    conform,
    convert,
    curves,
    filters,
    history,
    mutate,
    options,
    reference,
)
from tidemark.operators import fill as filling

@dataclass(frozen=True)
class ConvertedSymbol:
    """A symbol whose prices are asked for in another currency, another unit, or both. Empty text and a factor
    of 0 count as unset; without a source the rates are those of the ECB."""

    symbol: str
    currency: str | None = None
    currency_source: str | None = None
    unit: str | None = None
    unit_factor: float | None = None

    def __post_init__(self) -> None:
        if not self.symbol or "<*>" in self.symbol:
            raise ValueError("a converted symbol is one name")
        if self.currency and self.currency not in schemas.CURRENCIES:
            raise ValueError(f"unknown currency: {self.currency}")
        if self.unit and self.unit not in schemas.UNITS:
            raise ValueError(f"unknown unit: {self.unit}")


Symbols = str | ConvertedSymbol | Sequence[str | ConvertedSymbol] | DataFrame
Fields = str | Sequence[conform.Field] | None
TIME = "tradedatetimeutc"


def _split(symbols: Symbols) -> tuple[str | list[str] | DataFrame, list[ConvertedSymbol]]:
    """The names of a request's symbols, and those that are asked for converted."""
    if isinstance(symbols, DataFrame) or symbols is None:
        return symbols, []
    listed = [symbols] if isinstance(symbols, (str, ConvertedSymbol)) else list(symbols)
    specs = [s for s in listed if isinstance(s, ConvertedSymbol)]
    names = [s.symbol if isinstance(s, ConvertedSymbol) else s for s in listed]
    if len({s.symbol for s in specs}) < len(specs) or any(names.count(s.symbol) > 1 for s in specs):
        raise ValueError("a converted symbol is requested once")
    return (symbols if isinstance(symbols, str) else names), specs


@dataclass
class MarketData:
    """Named tables; a request needs only those it reads.

    prices(symbol, tradedatetimeutc, open..close, volume, ...), ticks(symbol, ts, last, volume, seq),
    curves(curveroot, curvedate, contract, value), series(symbol, field, ondate, index, value),
    instruments, metadata(symbol, property, value), folders(path, symbol), calendars(calendar,
    calendartype), holidays(calendar, holiday), rates(currency, source, ts, rate), units(unit,
    to_unit, factor), chain(symbol, underlier, expiry, callput, strike, underprice, ...),
    curve_config, curve_inputs, grants, currencies, exchanges, timezones, audit.

    ``ties`` names, per table, the columns that order rows of one symbol and time.
    """

    tables: Mapping[str, DataFrame] = field(default_factory=dict)
    ties: Mapping[str, Sequence[str]] = field(default_factory=lambda: {"ticks": ["seq"]})

    def _table(self, name: str) -> DataFrame:
        if name not in self.tables:
            raise ValueError(f"this request needs the table: {name}")
        return self.tables[name]

    def with_table(self, name: str, df: DataFrame) -> MarketData:
        """The same tables with one replaced: how an update is made visible to later requests."""
        return MarketData({**self.tables, name: df}, self.ties)

    # --- history ---------------------------------------------------------------------------------

    def _rows(self, df: DataFrame, time: str, symbols: Symbols, *, daysback=None, startdate=None,
              enddate=None, ondate=None, version=None, anchor=None) -> DataFrame:
        df = filters.for_symbols(df, _split(symbols)[0])
        if version is not None:
            df = filters.of_version(df, version)
        if startdate is not None or enddate is not None:
            df = filters.between(df, time, startdate, enddate)
        if ondate is not None:
            df = filters.between(df, time, end=ondate)
        if daysback is not None:
            df = filters.days_back(df, time, daysback, anchor)
        return df

    def _tie(self, name: str) -> list[str]:
        return list(self.ties.get(name, ()))

    def _corrected(self, df: DataFrame, table: str, time: str, updatetype: str | None,
                   lastupdatetime: dt.datetime | None) -> DataFrame:
        """The corrections feed when asked for, else the latest revision where rows have several."""
        order = ["lastupdatetime", *self._tie(table)]
        if updatetype is not None or lastupdatetime is not None:
            return filters.corrections(df, ["symbol", time], order, updatetype or "UI",
                                       lastupdatetime)
        if "lastupdatetime" in df.columns:
            return filters.latest_revision(df, ["symbol", time], order)
        return df

    def _converted(self, df: DataFrame, time: str, currency: str | None,
                   source: str | None, unit: str | None) -> DataFrame:
        """Every price column of the rows in the wanted currency and unit."""
        values = [c for c in schemas.PRICE_VALUES if c in df.columns]
        if currency is not None:
            if currency not in schemas.CURRENCIES:
                raise ValueError(f"unknown currency: {currency}")
            if "currency" not in df.columns:
                raise ValueError("these rows have no currency to convert from")
            df = convert.convert_prices(df, self._table("rates"), source or "ECB", currency, values, time)
        if unit is not None:
            if unit not in schemas.UNITS:
                raise ValueError(f"unknown unit: {unit}")
            kept = df.columns
            df = convert.convert_units(df.withColumn("to_unit", F.lit(unit)), self._table("units"), values[0])
            df = df.withColumns({v: F.col(v) * F.col("factor") for v in values})
            df = df.withColumn("unit", F.lit(unit)).select(*kept)
        return df

    def _as_wished(self, df: DataFrame, time: str, symbols: Symbols, currency: str | None,
                   source: str | None, unit: str | None) -> DataFrame:
        """Every price column as the request wishes, or as the request's symbols do."""
        specs = _split(symbols)[1]
        if not specs:
            return self._converted(df, time, currency, source, unit)
        if currency is not None or unit is not None:
            raise ValueError("name the currency and the unit for the request or for its symbols, not both")
        spark, kept = df.sparkSession, df.columns
        spec = spark.createDataFrame(
            [(s.symbol, s.currency or "", s.currency_source or "ECB", s.unit or "", float(s.unit_factor or 0)) for s in specs],
            "symbol string, to_currency string, currency_source string, to_unit string, unit_factor double")
        for column, wished in (("currency", any(s.currency for s in specs)), ("unit", any(s.unit for s in specs))):
            if column not in df.columns:
                if wished:
                    raise ValueError(f"these rows have no {column} to convert from")
                df = df.withColumn(column, F.lit(None).cast("string"))
        rates = self._table("rates") if any(s.currency for s in specs) else spark.createDataFrame(
            [], "currency string, source string, to_currency string, ts timestamp, rate double")
        if "to_currency" not in rates.columns:
            raise ValueError("rates need a to_currency column")
        factors = self._table("units") if any(s.unit and not s.unit_factor for s in specs) else spark.createDataFrame(
            [], "unit string, to_unit string, factor double")
        values = [c for c in schemas.PRICE_VALUES if c in df.columns]
        return convert.convert_by_spec(df, spec, rates, factors, values, time).select(*kept)

    def _holidays(self, calendar: str | None) -> DataFrame | None:
        return None if calendar is None else self._table("holidays").where(F.col("calendar") == calendar)

    def get_daily(self, symbols: Symbols, fields: Fields = None, daysback: int | None = None,
                  fill: str | None = None, maxrows: int | None = None,
                  recordsback: int | DataFrame | None = None, settledonly: bool = False,
                  startdate: dt.date | None = None, enddate: dt.date | None = None,
                  aggregatetype: int | None = None, currency: str | None = None,
                  currencysource: str | None = None, lotunits: str | None = None,
                  ondate: dt.date | None = None, version: str | None = None,
                  updatetype: str | None = None, lastupdatetime: dt.datetime | None = None,
                  fill_calendar: str = "business", anchor: dt.datetime | None = None,
                  timezone: str | None = None, holidays: str | None = None) -> DataFrame:
        """``recordsback`` may be a fetch plan, with a depth for each symbol. ``timezone`` (``publisher``: each
        row's ``zone``) and ``holidays``, a calendar's name, say what the local day and its peak hours are for an
        ``aggregatetype``. ``settledonly`` looks at the revision that counts: an unsettled one hides those
        before it."""
        if fill is not None and fill not in schemas.FILL_METHODS:
            raise ValueError(f"unknown fill method: {fill}")
        if aggregatetype is not None and aggregatetype not in schemas.AGGREGATE_TYPES:
            raise ValueError(f"unknown aggregate type: {aggregatetype}")
        limits = dict(daysback=daysback, startdate=startdate, enddate=enddate, ondate=ondate,
                      version=version, anchor=anchor)
        if aggregatetype is not None:
            if settledonly or updatetype is not None or lastupdatetime is not None:
                raise ValueError("settledonly and corrections do not apply to aggregated hours")
            ticks = self._rows(self._table("ticks"), "ts", symbols, **limits)
            ticks = self._as_wished(ticks, "ts", symbols, currency, currencysource, lotunits)
            zone = F.col("zone") if timezone == "publisher" else timezone or "UTC"
            df = bars.aggregate_hours(ticks, aggregatetype, zone, self._holidays(holidays), tie=self._tie("ticks"))
            df = df.withColumnRenamed("day", TIME)
            if currency is not None:
                df = df.withColumn("currency", F.lit(currency))
        else:
            df = self._rows(self._table("prices"), TIME, symbols, **limits)
            df = self._corrected(df, "prices", TIME, updatetype, lastupdatetime)
            if settledonly:
                df = filters.settled_only(df)
            df = self._as_wished(df, TIME, symbols, currency, currencysource, lotunits)
        tie = [c for c in self._tie("prices") if c in df.columns]
        if fill is not None:
            values = [c for c in (*schemas.PRICE_VALUES, "volume", "openinterest") if c in df.columns]
            daily = filling.daily_rows(df, ["symbol"], TIME, values, tie).withColumnRenamed("day", TIME)
            df, tie = filling.fill_all(daily, ["symbol"], TIME, values, fill, fill_calendar, enddate,
                                       recordsback if isinstance(recordsback, int) else None), []
        if isinstance(recordsback, DataFrame):
            df = filters.records_back_by_plan(df, recordsback, TIME, tie)
        elif recordsback is not None:
            df = filters.records_back(df, ["symbol"], TIME, recordsback, tie)
        if maxrows is not None:
            df = filters.max_rows(df, ["symbol", TIME, *tie], maxrows)
        return df if fields is None else conform.select_fields(df, fields)

    def get_intraday(self, symbols: Symbols, fields: Fields = None, daysback: int | None = None,
                     recordsback: int | None = None, startdate: dt.date | None = None,
                     enddate: dt.date | None = None, aggregatetype: int | None = None,
                     currency: str | None = None, currencysource: str | None = None,
                     lotunits: str | None = None, intradaybarinterval: int | None = None,
                     timezone: str | None = None, ondate: dt.date | None = None,
                     version: str | None = None, updatetype: str | None = None,
                     lastupdatetime: dt.datetime | None = None,
                     anchor: dt.datetime | None = None, holidays: str | None = None) -> DataFrame:
        """``timezone='publisher'`` takes each row's zone from its ``zone`` column. ``holidays`` names the
        calendar whose days, in that zone, have no peak hours."""
        if aggregatetype is not None and aggregatetype not in schemas.AGGREGATE_TYPES:
            raise ValueError(f"unknown aggregate type: {aggregatetype}")
        df = self._rows(self._table("ticks"), "ts", symbols, daysback=daysback,
                        startdate=startdate, enddate=enddate, ondate=ondate, version=version,
                        anchor=anchor)
        if updatetype is not None or lastupdatetime is not None:
            df = self._corrected(df, "ticks", "ts", updatetype, lastupdatetime)
        df = self._as_wished(df, "ts", symbols, currency, currencysource, lotunits)
        zone: Column | str | None = F.col("zone") if timezone == "publisher" else timezone
        if aggregatetype:
            df = bars.in_hours(df, df["ts"] if zone is None else F.from_utc_timestamp("ts", zone), aggregatetype, self._holidays(holidays))
        if zone is not None:
            df = df.withColumn("ts", F.from_utc_timestamp("ts", zone))
        time = "ts"
        if intradaybarinterval is not None:
            df, time = bars.bars(df, intradaybarinterval, tie=self._tie("ticks")), "bar"
        if recordsback is not None:
            tie = [c for c in self._tie("ticks") if c in df.columns]
            df = filters.records_back(df, ["symbol"], time, recordsback, tie)
        return df if fields is None else conform.select_fields(df, fields)

    def get_quote(self, symbols: Symbols, fields: Fields = "QUOTE_ALL", grain: str = "month") -> DataFrame:
        """Newest row per symbol with previous-session, change and running fields. ``grain`` sizes the
        segments that histories are cut into: smaller for very dense symbols."""
        if symbols is None or fields is None:
            raise ValueError("symbols and fields are required")
        prices = filters.for_symbols(self._table("prices"), symbols)
        made = {*history.SESSION_FIELDS, "netchange", "percentchange", "mostrecentvalue",
                "mostrecentvaluedate", "lasttradedirection", "historicvolume"}
        rows = history.session_fields(
            prices.select(*[c for c in prices.columns if c not in made]), TIME, self._tie("prices"), grain)
        if "midpoint" not in rows.columns:
            rows = rows.withColumn("midpoint", bars.midpoint(rows))
        asked = set(schemas.FIELD_PRESETS.get(fields.upper(), ()) if isinstance(fields, str) else
                    [f[0] if isinstance(f, (list, tuple)) else f for f in fields])
        rest = [c for c in rows.columns if c not in ("symbol", TIME) and c in {str(a).strip('"') for a in asked}]
        return conform.select_fields(bars.latest_quote(rows, rest, TIME, self._tie("prices")), fields)

    def get_historical_tick(self, symbols: Symbols, fields: Fields = None,
                            daysback: int | None = None,
                            anchor: dt.datetime | None = None) -> DataFrame:
        df = self._rows(self._table("ticks"), "ts", symbols, daysback=daysback, anchor=anchor)
        df = df.orderBy("symbol", "ts", *self._tie("ticks"))
        return df if fields is None else conform.select_fields(df, fields)

    # --- curves and series -----------------------------------------------------------------------

    def get_chain(self, optionroot: str | Sequence[str], fields: Fields = "ALL",
                  securitytype: str | None = None, ondate: dt.date | None = None) -> DataFrame:
        if fields is None:
            raise ValueError("fields are required")
        found = curves.option_chain(self._table("prices"), optionroot, securitytype, ondate,
                                    tie=self._tie("prices"))
        return conform.select_fields(found, fields)

    def _curves(self, symbol: str | Sequence[str], ignoreerrors: bool) -> DataFrame:
        if symbol is None:
            raise ValueError("symbol is required")
        names = [symbol] if isinstance(symbol, str) else list(symbol)
        points = self._table("curves").where(F.col("curveroot").isin(*names))
        if not ignoreerrors:
            curves.check_roots(names, points, "curveroot")
        return points

    def get_daily_curve(self, symbol: str | Sequence[str], fields: Fields = None,
                        curvedate: dt.date | None = None, curvedatestart: dt.date | None = None,
                        curvedateend: dt.date | None = None, curvesize: int | None = None,
                        curvevaluetype: int = 0, ignoreerrors: bool = False) -> DataFrame:
        """Derived values are taken on the whole curve before its first contracts are cut out."""
        if curvevaluetype not in schemas.CURVE_VALUES:
            raise ValueError(f"unknown curve value type: {curvevaluetype}")
        points = self._curves(symbol, ignoreerrors)
        out = curves.daily_curve(curves.curve_values(points, curvevaluetype), None, curvedate,
                                 curvedatestart, curvedateend, curvesize)
        return out if fields is None else conform.select_fields(out, fields)

    def get_table(self, symbol: str | Sequence[str], fields: Fields,
                  curvedate: dt.date | str | None = None, curvedatestart: dt.date | None = None,
                  curvedateend: dt.date | None = None, curveversion: str | None = None,
                  ignoreerrors: bool = False) -> DataFrame:
        if fields is None:
            raise ValueError("fields are required")
        points = self._curves(symbol, ignoreerrors)
        return conform.select_fields(
            curves.curve_table(points, curvedate, curvedatestart, curvedateend, curveversion), fields)

    def search_curves(self, **wanted: str) -> DataFrame:
        return curves.search_curves(self._table("curve_config"), **wanted)

    def update_curves(self, body: DataFrame) -> DataFrame | dict[str, DataFrame]:
        """The stored curve points with the body's tenors put in. A body without tenors is a
        configuration: the tables of its parts then."""
        if "tenors" not in body.columns:
            names = {"curve": "curve_config", "inputs": "curve_inputs", "settings": "curve_settings",
                     "properties": "curve_properties"}
            held = {part: self.tables[name] for part, name in names.items() if name in self.tables}
            return mutate.update_curve_configuration(held, body)
        return mutate.update_curves(self._table("curve_points"), body)

    def get_curve_timeseries(self, symbol: Symbols, curvedate: dt.date | str,
                             fields: Fields = None, startdate: dt.date | None = None,
                             enddate: dt.date | None = None,
                             timezone: str | None = None) -> DataFrame:
        series = filters.for_symbols(self._table("series"), symbol)
        df = curves.series_as_of(series, curvedate, startdate, enddate)
        if timezone is not None:
            df = df.withColumn("index", F.from_utc_timestamp("index", timezone))
        return df if fields is None else conform.select_fields(df, fields)

    def update_timeseries(self, body: DataFrame, frequency: str | None = None) -> DataFrame:
        return mutate.update_timeseries(
            self._table("series"), mutate.series_rows(body, frequency))

    def delete_timeseries(self, items: DataFrame) -> DataFrame:
        return mutate.delete_timeseries(self._table("series"), items)

    def update_data(self, wide: DataFrame, reason: str | None = None,
                    stored: bool = False) -> dict[str, DataFrame]:
        """The series, metadata and folder rows of a wide update; with ``stored``, these tables as the
        update leaves them."""
        if stored:
            return mutate.update_data(self.tables, wide, reason)
        out = {"series": mutate.with_reason(mutate.update_prices_long(wide), reason),
               "metadata": mutate.update_metadata_long(wide)}
        if "FOLDER_PATH" in wide.columns:
            out["folders"] = mutate.update_folders(wide)
        return out

    def update_data_status(self, run_id: str) -> DataFrame:
        return mutate.load_status(self._table("audit"), run_id)

    # --- calendars -------------------------------------------------------------------------------

    def get_calendar(self, calendar: Sequence[str] | None = None,
                     calendartype: str | None = None) -> DataFrame:
        return calendars.list_calendars(self._table("calendars"), calendar, calendartype)

    def _calendar_rows(self, names: str | Sequence[str]) -> DataFrame:
        wanted = [names] if isinstance(names, str) else list(names)
        if not wanted or not all(isinstance(n, str) for n in wanted):
            raise ValueError("a calendar is a name or a list of names")
        return self._table("calendars").where(F.col("calendar").isin(*wanted)).select("calendar")

    def get_calendar_details(self, calendar: str, startdate: dt.date, enddate: dt.date,
                             tenor: Sequence[str] | None = None, quoting: bool = False,
                             kind: str = "holiday") -> DataFrame:
        """``kind='rollover'`` gives expiry dates instead of holidays."""
        if calendar is None:
            raise ValueError("calendar is required")
        return calendars.calendar_details(
            self._calendar_rows(calendar), self._table("holidays"), startdate, enddate, quoting,
            "rollover" if tenor else kind, tenor)

    def get_contract_details(self, rollover: str | Sequence[str], startdate: dt.date,
                             enddate: dt.date, tenor: str | Sequence[str] = ("M01",),
                             ondate: dt.date | None = None) -> DataFrame:
        for value in (startdate, enddate, *([ondate] if ondate else [])):
            if not isinstance(value, dt.date):
                raise ValueError("start, end and on-date are dates")
        tenors = [tenor] if isinstance(tenor, str) else list(tenor)
        return calendars.contract_details(
            self._calendar_rows(rollover), self._table("holidays"), tenors, startdate, enddate,
            ondate)

    # --- metadata, folders, symbols --------------------------------------------------------------

    def get_metadata(self, symbols: str | Sequence[str],
                     fields: Sequence[str] | None = None) -> DataFrame:
        """One row per symbol with the named properties; without names, one row per property."""
        if symbols is None:
            raise ValueError("symbols are required")
        names = [symbols] if isinstance(symbols, str) else list(symbols)
        if fields is None:
            return filters.for_symbols(self._table("metadata"), names)
        return reference.get_metadata(self._table("metadata"), fields, names)

    def search_metadata(self, **wanted: Sequence[str]) -> DataFrame:
        return reference.search_metadata(self._table("metadata"), wanted)

    def update_metadata(self, items: DataFrame) -> DataFrame:
        return mutate.update_metadata(self._table("metadata"), items)

    def delete_metadata(self, items: DataFrame) -> DataFrame:
        return mutate.delete_metadata(self._table("metadata"), items)

    def get_folder(self, folder: str) -> DataFrame:
        return reference.get_folder(self._table("folders"), folder)

    def update_folder(self, body: DataFrame, reason: str | None = None) -> DataFrame:
        """A reason given here replaces the body's own."""
        if reason is not None:
            body = mutate.with_reason(body, reason)
        return mutate.update_folder(self._table("folders"), body)

    def delete_folder(self, folders: Sequence[str]) -> DataFrame:
        return mutate.delete_folder(self._table("folders"), folders)

    def symbol_search(self, pattern: str) -> DataFrame:
        return filters.symbol_search(self._table("instruments"), pattern)

    def symbol_search_by_exchange(self, exchangecode: str, expirationdate: dt.date | None = None,
                                  securitytype: str | None = None,
                                  createdate: dt.date | None = None,
                                  recordsback: int | None = None) -> DataFrame:
        return filters.search_by_exchange(self._table("instruments"), exchangecode, securitytype,
                                          expirationdate, createdate, recordsback)

    def get_symbol_information(self, symbol: Symbols, ondate: dt.date | None = None,
                               info: str | None = None) -> DataFrame:
        """Coverage, or the versions known on a date, or the inputs of a built curve."""
        if info == "inputs":
            return filters.for_symbols(self._table("curve_inputs"), symbol)
        if info not in (None, "versions"):
            raise ValueError(f"unknown info: {info}")
        prices = filters.for_symbols(self._table("prices"), symbol)
        if info == "versions":
            return filters.symbol_versions(prices, ondate)
        return filters.symbol_coverage(filters.between(prices, TIME, end=ondate))

    def get_instrument_list(self, exchangecode: str | None = None, optionroot: str | None = None,
                            symbol: str | Sequence[str] | None = None) -> DataFrame:
        return filters.instrument_list(self._table("instruments"), exchangecode, optionroot, symbol)

    def delete_symbol(self, symbols: Sequence[str]) -> dict[str, DataFrame]:
        """Every table that has a symbol column, without the symbols."""
        return {name: mutate.delete_symbol(df, symbols) for name, df in self.tables.items()
                if "symbol" in df.columns}

    # --- lists -----------------------------------------------------------------------------------

    def get_currency_list(self) -> DataFrame:
        table = self._table("currencies")
        return reference.dimension(table, table.columns)

    def get_exchange_list(self) -> DataFrame:
        table = self._table("exchanges")
        return reference.dimension(table, table.columns)

    def get_permissioned_roots(self, fields: Sequence[str]) -> DataFrame:
        if fields is None:
            raise ValueError("fields are required")
        return reference.permissioned_roots(
            self._table("instruments"), self._table("grants"), fields=fields)

    def get_timezones(self, timezones: Sequence[str] | None = None,
                      ianaCodes: Sequence[str] | None = None) -> DataFrame:
        table = self._table("timezones")
        return reference.dimension(table, table.columns, timezone=timezones, iana_code=ianaCodes)

    def get_unit_list(self, symbol: str) -> DataFrame:
        return reference.units_of(self._table("instruments"), self._table("units"), symbol)

    # --- options ---------------------------------------------------------------------------------

    def get_option_analytics(self, fields: Fields, valuation: dt.date, callput: str | None = None,
                             strikecount: int | None = None, underlier: str | None = None,
                             optionmodel: str = "bs",
                             underlierpriceselection: Sequence[str] = ("underprice",),
                             contractpriceselection: Sequence[str] | None = None,
                             volatility: float | None = None, interestrate: float = 0.0,
                             foreigninterestrate: float | None = None, yeardaycount: float = 365,
                             dividendyield: float = 0.0, futures: bool = False,
                             symbols: Symbols | None = None) -> DataFrame:
        if fields is None:
            raise ValueError("fields are required")
        chain = self._table("chain")
        if symbols is not None:
            chain = filters.for_symbols(chain, symbols)
        if callput is not None:
            chain = chain.where(F.col("callput") == callput)
        if underlier is not None:
            chain = chain.where(F.col("underlier") == underlier)
        if strikecount is not None:
            chain = options.strike_window(chain, strikecount)
        vol = "vol" if volatility is None else F.lit(float(volatility))
        out = options.analytics(
            chain, valuation, vol, interestrate, dividendyield, foreigninterestrate, yeardaycount,
            futures, underlierpriceselection, contractpriceselection, optionmodel)
        return conform.select_fields(out, fields)

    def get_option_analytics_single(self, fields: Fields, valuation: dt.date, symbols: Symbols,
                                    **arguments) -> DataFrame:
        return self.get_option_analytics(fields, valuation, symbols=symbols, **arguments)

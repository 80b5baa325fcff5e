"""Column roles and the fixed values of the passenger-flow data model."""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values: they name columns and choose results, so they must stay as they are. ---

STATISTICS = ("mean", "min", "max", "std", "median")

# Calendar offsets of the raw lags, as Spark interval text.
LAGS = {
    "1year": "1 year",
    "6months": "6 months",
    "3months": "3 months",
    "1month": "1 month",
    "1week": "7 days",
}

# Rolling windows, counted in rows of the group.
ROLLING_ROWS = {"week": 7, "month": 30, "quarter": 91, "semester": 182, "year": 365}

# Trend ratios: statistics over the short window divided by those over the long one, in days.
TREND_DAYS = ((7, 14), (14, 30), (30, 91), (91, 182), (182, 365))

# Centered windows looked up after a fixed delay: name -> (delay, window), in days.
LAGGED_WINDOWS = {
    "lag365_win28": (365, 28),
    "lag182_win20": (182, 20),
    "lag91_win20": (91, 20),
    "lag30_win14": (30, 14),
    "lag7_win6": (7, 6),
}

MOMENTUM_PAIRS = (
    ("week", "month"),
    ("month", "quarter"),
    ("quarter", "semester"),
    ("semester", "year"),
)

# Periods of the sine/cosine pairs.
CYCLES = {"Minute": 60, "Hour": 24, "Month": 12, "DayOfWeek": 7, "Hour_Of_Week": 168}

DEPARTURE = "Départ"
UNASSIGNED_TERMINAL = "Terminal Non Affecté"

PAX_PER_LANE = 200
STAFF_PER_LANE = 8
SHIFT_HOURS = 6
HOURLY_RATE = 25

FRENCH_CODES = ("FR", "LF", "GP", "MQ", "RE")
CALENDAR_START = "2023-01-01"
CALENDAR_END = "2027-12-31"
CHUNK_DAYS = 1095
FRENCH_ZONES = (
    "Zone A", "Zone B", "Zone C",
    "Corse", "Guadeloupe", "Réunion", "Martinique", "Guyane", "Mayotte",
)
HOLIDAY_WORDS = ("Vacances", "Été")

# City as it appears in the airport table -> school district that sets its holidays.
CITY_DISTRICT = {
    "Figari": "Corse",
    "Figari-Sud": "Corse",
    "Ajaccio": "Corse",
    "Bastia": "Corse",
    "Calvi": "Corse",
    "Pointe-a-Pitre": "Guadeloupe",
    "Pointe": "Guadeloupe",
    "St-Denis": "Réunion",
    "Saint-Denis": "Réunion",
    "Fort-de-France": "Martinique",
    "Cayenne": "Guyane",
    "Dzaoudzi": "Mayotte",
    "Biarritz": "Bordeaux",
    "Pau": "Bordeaux",
    "Chambery": "Grenoble",
    "Annecy": "Grenoble",
    "Saint-Etienne": "Lyon",
    "Clermont": "Clermont-Ferrand",
    "Dole": "Besançon",
    "Pontarlier": "Besançon",
    "La Rochelle": "Poitiers",
    "La-Rochelle": "Poitiers",
    "Larochelle": "Poitiers",
    "Poitiers": "Poitiers",
    "Niort": "Poitiers",
    "Angouleme": "Poitiers",
    "Vannes": "Rennes",
    "Brest": "Rennes",
    "Lorient": "Rennes",
    "Quimper": "Rennes",
    "Saint-Jacques": "Rennes",
    "Beauvais": "Amiens",
    "Deauville": "Normandie",
    "Caen": "Normandie",
    "Toulon": "Nice",
    "Marseille": "Aix-Marseille",
    "Metz": "Nancy-Metz",
    "Nancy": "Nancy-Metz",
    "Bale": "Strasbourg",
    "Mulhouse": "Strasbourg",
    "Saint-Louis": "Strasbourg",
    "Perpignan": "Montpellier",
    "Tarbes": "Toulouse",
    "Rodez": "Toulouse",
    "Carcassonne": "Montpellier",
    "Nimes": "Montpellier",
    "Orly": "Paris",
    "Roissy": "Paris",
}

MOVEMENTS_DDL = """
    IdMovement BIGINT, IdADL BIGINT, IdAircraftType STRING, IdBusinessUnitType INT,
    IdBusContactType INT, IdTerminalType INT, IdBagStatusDelivery INT, NbFlight INT,
    AirportCode STRING, airlineOACICode STRING, SysStopover STRING, AirportOrigin STRING,
    AirportPrevious STRING, ServiceCode STRING, flightNumber STRING, OperatorFlightNumber STRING,
    FlightNumberNormalized STRING, OperatorOACICodeNormalized STRING,
    LTScheduledDatetime TIMESTAMP_NTZ, LTScheduledTime STRING, LTExternalDatetime TIMESTAMP_NTZ,
    LTExternalDate DATE, LTExternalTime STRING, Direction STRING, Terminal STRING,
    SysTerminal STRING, FuelProvider STRING, ScheduleType STRING, NbOfSeats INT,
    NbPaxTotal INT, FarmsNbPaxPHMR INT, etl_origin STRING
"""
PREDICTIONS_DDL = """
    FlightNumberNormalized STRING, LTScheduledDatetime TIMESTAMP_NTZ,
    PredNbPaxTotal DOUBLE, PredFarmsNbPaxPHMR DOUBLE
"""
ACTUALS_DDL = """
    FlightNumberNormalized STRING, LTScheduledDatetime TIMESTAMP_NTZ, NbPaxTotal INT,
    FarmsNbPaxPHMR INT, SysTerminal STRING, Direction STRING
"""


@dataclass(frozen=True)
class Roles:
    """Which column plays which part. ``row_id`` must be unique: it breaks ties and joins results."""

    time: str = "LTScheduledDatetime"
    row_id: str = "IdMovement"
    target: str = "NbPaxTotal"
    reduced_target: str = "FarmsNbPaxPHMR"
    flight: str = "FlightNumberNormalized"
    seats: str = "NbOfSeats"
    terminal: str = "SysTerminal"
    direction: str = "Direction"
    previous_airport: str = "AirportPrevious"
    groups: tuple[str, ...] = (
        "SysTerminal",
        "IdAircraftType",
        "FlightNumberNormalized",
        "airlineOACICode",
    )


# --- end of fixed values ---


MOVEMENT_COLUMNS = tuple(part.split()[0] for part in MOVEMENTS_DDL.split(","))

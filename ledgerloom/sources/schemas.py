"""Layouts of the raw batch files and of the warehouse tables.

Fixed values: file and field names, their order, record offsets and the target columns are those
of the published file formats and warehouse schema. Identifiers are bigint, amounts decimal with a
scale, business times carry no zone, times of day are HH:mm:ss text.
"""

from __future__ import annotations

# --- delimited files: name, separator, columns ---------------------------------------------------

DATE = """
SK_DateID BIGINT, DateValue DATE, DateDesc STRING, CalendarYearID INT, CalendarYearDesc STRING,
CalendarQtrID INT, CalendarQtrDesc STRING, CalendarMonthID INT, CalendarMonthDesc STRING,
CalendarWeekID INT, CalendarWeekDesc STRING, DayOfWeeknumeric INT, DayOfWeekDesc STRING,
FiscalYearID INT, FiscalYearDesc STRING, FiscalQtrID INT, FiscalQtrDesc STRING, HolidayFlag STRING
"""
TIME = """
SK_TimeID BIGINT, TimeValue STRING, HourID INT, HourDesc STRING, MinuteID INT, MinuteDesc STRING,
SecondID INT, SecondDesc STRING, MarketHoursFlag STRING, OfficeHoursFlag STRING
"""
INDUSTRY = "IN_ID STRING, IN_NAME STRING, IN_SC_ID STRING"
STATUS_TYPE = "ST_ID STRING, ST_NAME STRING"
TAX_RATE = "TX_ID STRING, TX_NAME STRING, TX_RATE DECIMAL(6, 5)"
TRADE_TYPE = "TT_ID STRING, TT_NAME STRING, TT_IS_SELL INT, TT_IS_MRKT INT"
BROKER = """
EmployeeID BIGINT, ManagerID BIGINT, EmployeeFirstName STRING, EmployeeLastName STRING,
EmployeeMI STRING, EmployeeJobCode INT, EmployeeBranch STRING, EmployeeOffice STRING, EmployeePhone STRING
"""
PROSPECT = """
AgencyID STRING, LastName STRING, FirstName STRING, MiddleInitial STRING, Gender STRING,
AddressLine1 STRING, AddressLine2 STRING, PostalCode STRING, City STRING, State STRING,
Country STRING, Phone STRING, Income BIGINT, NumberCars INT, NumberChildren INT,
MaritalStatus STRING, Age INT, CreditRating INT, OwnOrRentFlag STRING, Employer STRING,
NumberCreditCards INT, NetWorth BIGINT
"""
CASH_TRANSACTION = "CT_CA_ID BIGINT, CT_DTS TIMESTAMP_NTZ, CT_AMT DECIMAL(10, 2), CT_NAME STRING"
WATCH_HISTORY = "W_C_ID BIGINT, W_S_SYMB STRING, W_DTS TIMESTAMP_NTZ, W_ACTION STRING"
TRADE = """
T_ID BIGINT, T_DTS TIMESTAMP_NTZ, T_ST_ID STRING, T_TT_ID STRING, T_IS_CASH STRING, T_S_SYMB STRING,
T_QTY INT, T_BID_PRICE DECIMAL(8, 2), T_CA_ID BIGINT, T_EXEC_NAME STRING, T_TRADE_PRICE DECIMAL(8, 2),
T_CHRG DECIMAL(10, 2), T_COMM DECIMAL(10, 2), T_TAX DECIMAL(10, 2)
"""
TRADE_HISTORY = "TH_T_ID BIGINT, TH_DTS TIMESTAMP_NTZ, TH_ST_ID STRING"
HOLDING_HISTORY = "HH_H_T_ID BIGINT, HH_T_ID BIGINT, HH_BEFORE_QTY INT, HH_AFTER_QTY INT"
DAILY_MARKET = """
DM_DATE DATE, DM_S_SYMB STRING, DM_CLOSE DECIMAL(8, 2), DM_HIGH DECIMAL(8, 2), DM_LOW DECIMAL(8, 2), DM_VOL BIGINT
"""
AUDIT = """
DataSet STRING, BatchID INT, AT_Date DATE, AT_Attribute STRING, AT_Value DECIMAL(15, 0), DValue DECIMAL(15, 5)
"""

# {table: (file, separator, columns)}
REFERENCE_FILES = {
    "DimDate": ("Date.txt", "|", DATE),
    "DimTime": ("Time.txt", "|", TIME),
    "Industry": ("Industry.txt", "|", INDUSTRY),
    "StatusType": ("StatusType.txt", "|", STATUS_TYPE),
    "TaxRate": ("TaxRate.txt", "|", TAX_RATE),
    "TradeType": ("TradeType.txt", "|", TRADE_TYPE),
}
STAGING_FILES = {
    "S_Prospect": ("Prospect.csv", ",", PROSPECT),
    "S_Broker": ("HR.csv", ",", BROKER),
    "S_Cash_Balances": ("CashTransaction.txt", "|", CASH_TRANSACTION),
    "S_Watches": ("WatchHistory.txt", "|", WATCH_HISTORY),
    "S_Fact_Holding": ("HoldingHistory.txt", "|", HOLDING_HISTORY),
    "S_DailyMarketHistory": ("DailyMarket.txt", "|", DAILY_MARKET),
    "S_Trade": ("Trade.txt", "|", TRADE),
    "S_Trade_History": ("TradeHistory.txt", "|", TRADE_HISTORY),
}
# Read as text and turned into booleans: the reader itself knows only true and false.
FLAGS = {
    "DimDate": ("HolidayFlag",),
    "DimTime": ("MarketHoursFlag", "OfficeHoursFlag"),
    "S_Trade": ("T_IS_CASH",),
}

# --- fixed-width file: three record types --------------------------------------------------------

FINWIRE_TYPE = (15, 18)
FINWIRE = {
    "CMP": {
        "PTS": (0, 15), "REC_TYPE": (15, 18), "COMPANY_NAME": (18, 78), "CIK": (78, 88),
        "STATUS": (88, 92), "INDUSTRY_ID": (92, 94), "SP_RATING": (94, 98), "FOUNDING_DATE": (98, 106),
        "ADDR_LINE_1": (106, 186), "ADDR_LINE_2": (186, 266), "POSTAL_CODE": (266, 278),
        "CITY": (278, 303), "STATE_PROVINCE": (303, 323), "COUNTRY": (323, 347),
        "CEO_NAME": (347, 393), "DESCRIPTION": (393, None),
    },
    "SEC": {
        "PTS": (0, 15), "REC_TYPE": (15, 18), "SYMBOL": (18, 33), "ISSUE_TYPE": (33, 39),
        "STATUS": (39, 43), "NAME": (43, 113), "EX_ID": (113, 119), "SH_OUT": (119, 132),
        "FIRST_TRADE_DATE": (132, 140), "FIRST_TRADE_EXCHANGE": (140, 148), "DIVIDEN": (148, 160),
        "COMPANY_NAME_OR_CIK": (160, None),
    },
    "FIN": {
        "PTS": (0, 15), "REC_TYPE": (15, 18), "YEAR": (18, 22), "QUARTER": (22, 23),
        "QTR_START_DATE": (23, 31), "POSTING_DATE": (31, 39), "REVENUE": (39, 56), "EARNINGS": (56, 73),
        "EPS": (73, 85), "DILUTED_EPS": (85, 97), "MARGIN": (97, 109), "INVENTORY": (109, 126),
        "ASSETS": (126, 143), "LIABILITIES": (143, 160), "SH_OUT": (160, 173),
        "DILUTED_SH_OUT": (173, 186), "CO_NAME_OR_CIK": (186, None),
    },
}
FINWIRE_TABLES = {"CMP": "S_Company", "SEC": "S_Security", "FIN": "S_Financial"}

# --- nested XML file -----------------------------------------------------------------------------

ACTION_TAG = "TPCDI:Action"
_PHONE = "STRUCT<C_CTRY_CODE: STRING, C_AREA_CODE: STRING, C_LOCAL: STRING, C_EXT: STRING>"
ACTION = f"""
_ActionType STRING, _ActionTS STRING,
Customer STRUCT<
    _C_ID: STRING, _C_TAX_ID: STRING, _C_GNDR: STRING, _C_TIER: STRING, _C_DOB: STRING,
    Name: STRUCT<C_L_NAME: STRING, C_F_NAME: STRING, C_M_NAME: STRING>,
    Address: STRUCT<C_ADLINE1: STRING, C_ADLINE2: STRING, C_ZIPCODE: STRING, C_CITY: STRING,
                    C_STATE_PROV: STRING, C_CTRY: STRING>,
    ContactInfo: STRUCT<C_PRIM_EMAIL: STRING, C_ALT_EMAIL: STRING,
                        C_PHONE_1: {_PHONE}, C_PHONE_2: {_PHONE}, C_PHONE_3: {_PHONE}>,
    TaxInfo: STRUCT<C_LCL_TX_ID: STRING, C_NAT_TX_ID: STRING>,
    Account: ARRAY<STRUCT<_CA_ID: STRING, _CA_TAX_ST: STRING, CA_B_ID: STRING, CA_NAME: STRING>>>
"""
CUSTOMER_GROUPS = {
    "": ("C_TAX_ID", "C_GNDR", "C_TIER", "C_DOB"),
    "Name": ("C_L_NAME", "C_F_NAME", "C_M_NAME"),
    "Address": ("C_ADLINE1", "C_ADLINE2", "C_ZIPCODE", "C_CITY", "C_STATE_PROV", "C_CTRY"),
    "ContactInfo": ("C_PRIM_EMAIL", "C_ALT_EMAIL"),
    "TaxInfo": ("C_LCL_TX_ID", "C_NAT_TX_ID"),
}
PHONES = ("C_PHONE_1", "C_PHONE_2", "C_PHONE_3")
PHONE_PARTS = ("C_CTRY_CODE", "C_AREA_CODE", "C_LOCAL", "C_EXT")

# --- warehouse tables ----------------------------------------------------------------------------

TARGETS = {
    "DimBroker": """
        SK_BrokerID BIGINT, BrokerID BIGINT, ManagerID BIGINT, FirstName STRING, LastName STRING,
        MiddleInitial STRING, Branch STRING, Office STRING, Phone STRING, IsCurrent BOOLEAN,
        BatchID INT, EffectiveDate DATE, EndDate DATE""",
    "Prospect": """
        AgencyID STRING, SK_RecordDateID INT, SK_UpdateDateID INT, BatchID INT, IsCustomer BOOLEAN,
        LastName STRING, FirstName STRING, MiddleInitial STRING, Gender STRING, AddressLine1 STRING,
        AddressLine2 STRING, PostalCode STRING, City STRING, State STRING, Country STRING, Phone STRING,
        Income BIGINT, NumberCars INT, NumberChildren INT, MaritalStatus STRING, Age INT,
        CreditRating INT, OwnOrRentFlag STRING, Employer STRING, NumberCreditCards INT,
        NetWorth BIGINT, MarketingNameplate STRING""",
    "DimCompany": """
        SK_CompanyID BIGINT, CompanyID BIGINT, Status STRING, Name STRING, Industry STRING,
        SPrating STRING, isLowGrade BOOLEAN, CEO STRING, AddressLine1 STRING, AddressLine2 STRING,
        PostalCode STRING, City STRING, StateProv STRING, Country STRING, Description STRING,
        FoundingDate DATE, IsCurrent BOOLEAN, BatchID INT, EffectiveDate DATE, EndDate DATE""",
    "DimSecurity": """
        SK_SecurityID BIGINT, Symbol STRING, Issue STRING, Status STRING, Name STRING,
        ExchangeID STRING, SK_CompanyID BIGINT, SharesOutstanding BIGINT, FirstTrade DATE,
        FirstTradeOnExchange DATE, Dividend DECIMAL(10, 2), IsCurrent BOOLEAN, BatchID INT,
        EffectiveDate DATE, EndDate DATE""",
    "Financial": """
        SK_CompanyID BIGINT, FI_YEAR INT, FI_QTR INT, FI_QTR_START_DATE DATE, FI_REVENUE DECIMAL(15, 2),
        FI_NET_EARN DECIMAL(15, 2), FI_BASIC_EPS DECIMAL(10, 2), FI_DILUT_EPS DECIMAL(10, 2),
        FI_MARGIN DECIMAL(10, 2), FI_INVENTORY DECIMAL(15, 2), FI_ASSETS DECIMAL(15, 2),
        FI_LIABILITY DECIMAL(15, 2), FI_OUT_BASIC BIGINT, FI_OUT_DILUT BIGINT""",
    "DimCustomer": """
        SK_CustomerID BIGINT, CustomerID BIGINT, TaxID STRING, Status STRING, LastName STRING,
        FirstName STRING, MiddleInitial STRING, Gender STRING, Tier INT, DOB DATE, AddressLine1 STRING,
        AddressLine2 STRING, PostalCode STRING, City STRING, StateProv STRING, Country STRING,
        Phone1 STRING, Phone2 STRING, Phone3 STRING, Email1 STRING, Email2 STRING,
        NationalTaxRateDesc STRING, NationalTaxRate DECIMAL(6, 5), LocalTaxRateDesc STRING,
        LocalTaxRate DECIMAL(6, 5), AgencyID STRING, CreditRating INT, NetWorth BIGINT,
        MarketingNameplate STRING, IsCurrent BOOLEAN, BatchID INT, EffectiveDate DATE, EndDate DATE""",
    "DimAccount": """
        SK_AccountID BIGINT, AccountID BIGINT, SK_BrokerID BIGINT, SK_CustomerID BIGINT, Status STRING,
        AccountDesc STRING, TaxStatus INT, IsCurrent BOOLEAN, BatchID INT, EffectiveDate DATE,
        EndDate DATE""",
    "DimTrade": """
        TradeID BIGINT, SK_BrokerID BIGINT, SK_CreateDateID BIGINT, SK_CreateTimeID BIGINT,
        SK_CloseDateID BIGINT, SK_CloseTimeID BIGINT, Status STRING, Type STRING, CashFlag BOOLEAN,
        SK_SecurityID BIGINT, SK_CompanyID BIGINT, Quantity INT, BidPrice DECIMAL(8, 2),
        SK_CustomerID BIGINT, SK_AccountID BIGINT, ExecutedBy STRING, TradePrice DECIMAL(8, 2),
        Fee DECIMAL(10, 2), Commission DECIMAL(10, 2), Tax DECIMAL(10, 2), BatchID INT""",
    "FactCashBalances": """
        SK_CustomerID BIGINT, SK_AccountID BIGINT, SK_DateID BIGINT, Cash DECIMAL(15, 2), BatchID INT""",
    "FactHoldings": """
        TradeID BIGINT, CurrentTradeID BIGINT, SK_CustomerID BIGINT, SK_AccountID BIGINT,
        SK_SecurityID BIGINT, SK_CompanyID BIGINT, SK_DateID BIGINT, SK_TimeID BIGINT,
        CurrentPrice DECIMAL(8, 2), CurrentHolding INT, BatchID INT""",
    "FactWatches": """
        SK_CustomerID BIGINT, SK_SecurityID BIGINT, SK_DateID_DatePlaced BIGINT,
        SK_DateID_DateRemoved BIGINT, BatchID INT""",
    "DImessages": """
        MessageDateAndTime TIMESTAMP, BatchID INT, MessageSource STRING, MessageText STRING,
        MessageType STRING, MessageData STRING""",
}

# Columns that must identify a row of each target.
TARGET_KEYS = {
    "DimBroker": ("SK_BrokerID",),
    "DimCompany": ("CompanyID", "EffectiveDate"),
    "DimSecurity": ("Symbol", "EffectiveDate"),
    "DimCustomer": ("CustomerID", "EffectiveDate"),
    "DimAccount": ("AccountID", "EffectiveDate"),
    "DimTrade": ("TradeID",),
    "FactCashBalances": ("SK_AccountID", "SK_DateID"),
    "FactHoldings": ("TradeID",),
    "FactWatches": ("SK_CustomerID", "SK_SecurityID"),
}

JOB_CODE_BROKER = 314
OPEN_ACTIONS = ("NEW", "ADDACT")
ACCOUNT_ACTIONS = ("NEW", "ADDACT", "UPDACCT", "CLOSEACCT")
CUSTOMER_ACTIONS = ("NEW", "UPDCUST", "INACT")
TIERS = (1, 2, 3)
TAX_STATUSES = (0, 1, 2)
MARKET_ORDERS = ("TMB", "TMS")

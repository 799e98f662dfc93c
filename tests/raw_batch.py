"""A tiny, consistent raw batch, written file by file."""

from __future__ import annotations

from datetime import date, timedelta
from pathlib import Path

from ledgerloom.sources.schemas import FINWIRE

BATCH_DATE = "2017-07-07"


def finwire_line(kind: str, **values: str) -> str:
    layout = FINWIRE[kind]
    line = ""
    for name, (start, end) in layout.items():
        text = {"REC_TYPE": kind}.get(name, values.get(name, ""))
        line = line.ljust(start) + (text if end is None else text.ljust(end - start)[: end - start])
    return line


def company(day, name, cik, status="ACTV", industry="AA", rating="A+", **more):
    return finwire_line(
        "CMP", PTS=f"{day}-120000", COMPANY_NAME=name, CIK=f"{cik:010d}", STATUS=status,
        INDUSTRY_ID=industry, SP_RATING=rating, FOUNDING_DATE="19500101", ADDR_LINE_1="1 Main",
        POSTAL_CODE="12345", CITY="Town", STATE_PROVINCE="ST", COUNTRY="US", CEO_NAME="Pat O'Neil",
        DESCRIPTION="makes things", **more,
    )


def security(day, symbol, ref, status="ACTV", **more):
    return finwire_line(
        "SEC", PTS=f"{day}-120000", SYMBOL=symbol, ISSUE_TYPE="COMMON", STATUS=status, NAME=f"{symbol} share",
        EX_ID="NYSE", SH_OUT="0012345678901", FIRST_TRADE_DATE="19600101", FIRST_TRADE_EXCHANGE="19600102",
        DIVIDEN="1.25", COMPANY_NAME_OR_CIK=ref, **more,
    )


def financial(day, year, quarter, ref, **more):
    return finwire_line(
        "FIN", PTS=f"{day}-120000", YEAR=str(year), QUARTER=str(quarter), QTR_START_DATE=f"{year}0101",
        POSTING_DATE=f"{year}0401", REVENUE="1000.50", EARNINGS="10.25", EPS="1.10", DILUTED_EPS="1.05",
        MARGIN="0.20", INVENTORY="5.00", ASSETS="6.00", LIABILITIES="7.00", SH_OUT="100", DILUTED_SH_OUT="101",
        CO_NAME_OR_CIK=ref, **more,
    )


ACTIONS = """<?xml version="1.0" encoding="UTF-8"?>
<TPCDI:Actions xmlns:TPCDI="http://example.org/actions">
<TPCDI:Action ActionType="NEW" ActionTS="2010-01-01T08:00:00">
  <Customer C_ID="1" C_TAX_ID="T1" C_GNDR="f" C_TIER="1" C_DOB="1980-05-05">
    <Name><C_L_NAME>Ames</C_L_NAME><C_F_NAME>Ann</C_F_NAME><C_M_NAME>Q</C_M_NAME></Name>
    <Address><C_ADLINE1>1 Oak</C_ADLINE1><C_ADLINE2>Flat 2</C_ADLINE2><C_ZIPCODE>11111</C_ZIPCODE>
      <C_CITY>Rome</C_CITY><C_STATE_PROV>NY</C_STATE_PROV><C_CTRY>US</C_CTRY></Address>
    <ContactInfo><C_PRIM_EMAIL>a@x</C_PRIM_EMAIL><C_ALT_EMAIL>b@x</C_ALT_EMAIL>
      <C_PHONE_1><C_CTRY_CODE>1</C_CTRY_CODE><C_AREA_CODE>212</C_AREA_CODE><C_LOCAL>555-1</C_LOCAL><C_EXT>9</C_EXT></C_PHONE_1>
      <C_PHONE_2><C_CTRY_CODE/><C_AREA_CODE>313</C_AREA_CODE><C_LOCAL>555-2</C_LOCAL><C_EXT/></C_PHONE_2></ContactInfo>
    <TaxInfo><C_LCL_TX_ID>L1</C_LCL_TX_ID><C_NAT_TX_ID>N1</C_NAT_TX_ID></TaxInfo>
    <Account CA_ID="101" CA_TAX_ST="0"><CA_B_ID>7</CA_B_ID><CA_NAME>First</CA_NAME></Account>
    <Account CA_ID="102" CA_TAX_ST="1"><CA_B_ID>8</CA_B_ID><CA_NAME>Second</CA_NAME></Account>
  </Customer>
</TPCDI:Action>
<TPCDI:Action ActionType="NEW" ActionTS="2010-01-02T08:00:00">
  <Customer C_ID="2" C_TAX_ID="T2" C_GNDR="x" C_TIER="4" C_DOB="1910-01-01">
    <Name><C_L_NAME>Bell</C_L_NAME><C_F_NAME>Bo</C_F_NAME></Name>
    <Address><C_ADLINE1>2 Elm</C_ADLINE1><C_ZIPCODE>22222</C_ZIPCODE><C_CITY>Bern</C_CITY><C_STATE_PROV>BE</C_STATE_PROV></Address>
    <TaxInfo><C_NAT_TX_ID>N9</C_NAT_TX_ID></TaxInfo>
    <Account CA_ID="201" CA_TAX_ST="2"><CA_B_ID>7</CA_B_ID><CA_NAME>Third</CA_NAME></Account>
  </Customer>
</TPCDI:Action>
<TPCDI:Action ActionType="ADDACT" ActionTS="2011-03-01T09:00:00">
  <Customer C_ID="1"><Account CA_ID="103" CA_TAX_ST="5"><CA_B_ID>999</CA_B_ID><CA_NAME>Extra</CA_NAME></Account></Customer>
</TPCDI:Action>
<TPCDI:Action ActionType="UPDCUST" ActionTS="2012-06-01T09:00:00">
  <Customer C_ID="1" C_TIER="2">
    <Address><C_ADLINE2/></Address>
    <ContactInfo><C_PHONE_1><C_LOCAL>777</C_LOCAL></C_PHONE_1></ContactInfo>
  </Customer>
</TPCDI:Action>
<TPCDI:Action ActionType="UPDCUST" ActionTS="2012-06-01T10:00:00">
  <Customer C_ID="1"><ContactInfo><C_ALT_EMAIL/></ContactInfo></Customer>
</TPCDI:Action>
<TPCDI:Action ActionType="UPDACCT" ActionTS="2012-07-01T09:00:00">
  <Customer C_ID="1"><Account CA_ID="101"><CA_NAME>Renamed</CA_NAME></Account></Customer>
</TPCDI:Action>
<TPCDI:Action ActionType="CLOSEACCT" ActionTS="2013-01-01T09:00:00">
  <Customer C_ID="1"><Account CA_ID="102"/></Customer>
</TPCDI:Action>
<TPCDI:Action ActionType="INACT" ActionTS="2014-01-01T09:00:00">
  <Customer C_ID="1"/>
</TPCDI:Action>
<TPCDI:Action ActionType="UPDCUST" ActionTS="2015-01-01T09:00:00">
  <Customer C_ID="1"><ContactInfo><C_PRIM_EMAIL>new@x</C_PRIM_EMAIL></ContactInfo></Customer>
</TPCDI:Action>
<TPCDI:Action ActionType="UPDCUST" ActionTS="2015-05-01T09:00:00">
  <Customer C_ID="3" C_DOB="2030-01-01"><Name><C_L_NAME>Late</C_L_NAME></Name></Customer>
</TPCDI:Action>
</TPCDI:Actions>
"""

FILES = {
    "BatchDate.txt": BATCH_DATE + "\n",
    "Industry.txt": "AA|Aerospace|XX\nBB|Banking|XX\n",
    "StatusType.txt": "ACTV|Active\nCMPT|Completed\nCNCL|Canceled\nPNDG|Pending\nSBMT|Submitted\nINAC|Inactive\n",
    "TaxRate.txt": "N1|National one|0.30000\nL1|Local one|0.05000\nZZ|Unused|0.99999\n",
    "TradeType.txt": "TMB|Market Buy|0|1\nTMS|Market Sell|1|1\nTLB|Limit Buy|0|0\n",
    "HR.csv": (
        "7,1,Ann,Broker,M,314,B1,OFF1,555\n8,1,Bob,Broker,,314,B2,OFF2,556\n"
        "9,1,Cy,Clerk,,310,B2,OFF2,557\n10,1,Di,Nobody,,,B2,OFF2,558\n"
    ),
    "Prospect.csv": (
        "AG1,Ames,Ann,Q,F,1 Oak,,11111,Rome,NY,US,555,250000,2,4,M,46,700,O,Co,6,2000000\n"
        "AG0,AMES,ann,Q,F,1 oak,,11111,Rome,NY,US,555,0,0,0,S,20,0,O,Co,0,0\n"
        "AG2,Bell,Bo,,M,2 Elm,,22222,Bern,BE,,556,4000,4,0,S,24,500,R,,8,\n"
    ),
    "CashTransaction.txt": (
        "101|2012-01-01 10:00:00|100.50|in\n101|2012-01-01 11:00:00|-20.25|out\n"
        "101|2012-01-05 10:00:00|10.00|in\n201|2012-01-02 09:00:00|5.00|in\n555|2012-01-02 09:00:00|5.00|lost\n"
    ),
    "WatchHistory.txt": (
        "1|SYA|2011-01-01 10:00:00|ACTV\n1|SYA|2011-02-01 10:00:00|CNCL\n2|SYB|2011-01-01 10:00:00|ACTV\n"
        "2|SYB|2011-03-01 10:00:00|ACTV\n"
    ),
    "Trade.txt": (
        "1|2011-05-01 10:00:00|CMPT|TMB|1|SYA|100|12.55|101|Ann|12.60|1.10|2.20|3.30\n"
        "2|2011-06-01 10:00:00|CNCL|TLB|0|SYB|50|5.00|201|Bo|\\N|\\N|\\N|\\N\n"
        "3|2013-06-01 10:00:00|CMPT|TMS|1|SYA|40|13.00|101|Ann|13.05|1.00|1.00|1.00\n"
        "4|2011-07-01 10:00:00|SBMT|TMB|1|GONE|10|1.00|999|Cy|\\N|\\N|\\N|\\N\n"
    ),
    "TradeHistory.txt": (
        "1|2011-05-01 10:00:00|SBMT\n1|2011-05-01 10:00:05|CMPT\n"
        "2|2011-06-01 09:00:00|PNDG\n2|2011-06-02 10:00:00|SBMT\n2|2011-06-03 10:00:00|CNCL\n"
        "3|2013-06-01 10:00:00|SBMT\n3|2013-06-01 10:00:00|SBMT\n3|2013-06-01 10:00:30|CMPT\n"
        "4|2011-07-01 10:00:00|SBMT\n"
    ),
    "HoldingHistory.txt": "1|1|0|100\n1|3|100|60\n",
    "DailyMarket.txt": "2011-05-01|SYA|12.55|13.01|12.00|1000\n",
    "CustomerMgmt.xml": ACTIONS,
    "HR_audit.csv": "DataSet, BatchID, Date, Attribute, Value, DValue\nDimBroker,1,,HR_BROKERS,2,\n",
    "Trade_audit.csv": "DataSet, BatchID, Date, Attribute, Value, DValue\nDimTrade,1,2017-07-07,T_Records,4,\n",
    "FINWIRE2010Q1_audit.csv": "DataSet, BatchID, Date, Attribute, Value, DValue\nDimCompany,1,,FW_CMP,3,\n",
}


def write_batch(root: Path, scale: int = 1) -> str:
    folder = root / str(scale) / "Batch1"
    folder.mkdir(parents=True)
    for name, text in FILES.items():
        (folder / name).write_text(text)
    days = [date(2010, 1, 1) + timedelta(days=i) for i in range(8 * 365)]
    with open(folder / "Date.txt", "w") as out:
        for day in days:
            flag = "true" if (day.month, day.day) == (1, 1) else "0"
            out.write(f"{day:%Y%m%d}|{day}|d|{day.year}|y|1|q|1|m|1|w|{day.isoweekday()}|n|{day.year}|fy|1|fq|{flag}\n")
    with open(folder / "Time.txt", "w") as out:
        for second in range(86_400):
            h, m, s = second // 3600, second // 60 % 60, second % 60
            out.write(f"{second}|{h:02d}:{m:02d}:{s:02d}|{h}|h|{m}|m|{s}|s|{'true' if 9 <= h < 17 else 'false'}|1\n")
    first = [
        company("20090101", "O'Hara Works", 11),
        company("20120101", "O'Hara Works", 11, rating="CCC"),
        company("20090101", "Blue Bank", 12, industry="BB", rating=""),
        company("20090101", "Nowhere", 13, industry="??"),
        security("20090601", "SYA", f"{11:010d}"),
        security("20120601", "SYA", f"{11:010d}", status="INAC"),
        "".ljust(15) + "XYZ unknown type",
        *[financial("20100101", 1900 + i, 1, f"{11:010d}") for i in range(151)],
    ]
    (folder / "FINWIRE2009Q1").write_text("\n".join(first) + "\n")
    bad = company("20090101", "Bad\0Bytes", 14).encode().replace(b"\0", b"\xff")
    second = [security("20090601", "SYB", "Blue Bank"), financial("20130101", 2013, 2, "O'Hara Works")]
    (folder / "FINWIRE2009Q2").write_bytes(bad + b"\n" + ("\n".join(second) + "\n").encode())
    return str(root)

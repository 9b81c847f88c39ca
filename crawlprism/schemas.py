"""Fixed schemas of the page record, the fact tables and the event logs."""

from __future__ import annotations

from pyspark.sql import types as T

_BUTTON = "struct<text:string,selector:string>"
_POPUP = f"struct<text:string,selector:string,buttons:array<{_BUTTON}>>"
_FRAME = (
    "struct<isTop:boolean,origin:string,cleanedText:string,"
    f"buttons:array<{_BUTTON}>,potentialPopups:array<{_POPUP}>,"
    "llmPopupDetected:boolean,regexPopupDetected:boolean>"
)
_CMP = (
    "struct<name:string,final:boolean,open:boolean,started:boolean,succeeded:boolean,selfTestFail:boolean,"
    "errors:array<string>,patterns:array<string>,snippets:array<string>,filterListMatched:boolean>"
)

# Timed phases of consent handling per frame.
MEASURES = (
    "filterCMPs",
    "detectHeuristics",
    "heuristicDetector",
    "findCmpSiteSpecific",
    "findCmpGeneric",
    "findCmpHeuristic",
)
_PERFORMANCE = "struct<url:string,isMainFrame:boolean," + ",".join(f"{m}:array<double>" for m in MEASURES) + ">"

REQUEST = (
    "struct<url:string,method:string,type:string,initiators:array<string>,redirectedFrom:string,redirectedTo:string,"
    "status:int,remoteIPAddress:string,responseHeaders:map<string,string>,responseBodyHash:string,"
    "failureReason:string,size:bigint,time:double>"
)
COOKIE = "struct<name:string,domain:string,path:string,expires:bigint,session:boolean,sameSite:string>"
APIS = (
    "struct<callStats:map<string,map<string,bigint>>,"
    "savedCalls:array<struct<source:string,description:string,arguments:string>>>"
)
# Page sections, in document order. ``arguments`` of saved calls stays raw JSON: it is an
# array in most documents and a JSON string holding one in old ones.
SECTIONS = {
    "requests": f"array<{REQUEST}>",
    "cookies": f"array<{COOKIE}>",
    "targets": "array<struct<url:string,type:string>>",
    "apis": APIS,
    "elements": "struct<present:array<string>,visible:array<string>>",
    "screenshots": "string",
    "trace": "struct<traceEvents:array<struct<name:string,cat:string,ph:string,ts:bigint,args:map<string,string>>>>",
    "cookiepopups": (
        f"struct<cmps:array<{_CMP}>,performance:array<{_PERFORMANCE}>,scrapedFrames:array<{_FRAME}>>"
    ),
}
# Sections that are lists, with their smallest field.
ARRAY_SECTIONS = {"requests": "method", "cookies": "session", "targets": "type"}

PAGE_DDL = (
    "initialUrl string, finalUrl string, timeout boolean, testStarted bigint, testFinished bigint, "
    "data struct<" + ",".join(f"{k}:{v}" for k, v in SECTIONS.items()) + ">"
)

EVENT_DDL = (
    "page string, seq bigint, ts timestamp, kind string, requestId string, url string, method string, type string, "
    "time double, initiator string, "
    "redirectResponse struct<url:string,status:int,remoteIPAddress:string,headers:map<string,string>>, "
    "response struct<url:string,status:int,remoteIPAddress:string,headers:map<string,string>>, "
    "headers map<string,string>, encodedDataLength bigint, errorText string, body string, base64Encoded boolean"
)

RULE_DDL = (
    "name string, cosmetic boolean, vendorUrl string, "
    "_metadata struct<vendorUrl:string,manuallyReviewUpdates:boolean>, "
    "runContext struct<main:boolean,frame:boolean,urlPattern:string>, prehideSelectors array<string>, "
    "detectCmp array<struct<exists:string>>, detectPopup array<struct<visible:string>>, optIn array<string>, "
    "optOut array<struct<wait:bigint,waitForThenClick:string,comment:string>>, "
    "test array<struct<waitForVisible:string,timeout:bigint,check:string>>"
)


def page_schema() -> T.StructType:
    return T.StructType.fromDDL(PAGE_DDL)


def event_schema() -> T.StructType:
    return T.StructType.fromDDL(EVENT_DDL)


def rule_schema() -> T.StructType:
    return T.StructType.fromDDL(RULE_DDL)

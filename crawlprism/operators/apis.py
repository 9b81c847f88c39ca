"""Script-API calls: dictionary, attribution, counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlprism.functions.scripts import frame_source
from crawlprism.functions.urls import is_storable

# Probed object -> members, as they appear in call descriptions.
PROBES = {
    "window": "devicePixelRatio localStorage sessionStorage indexedDB name innerWidth innerHeight outerWidth "
    "outerHeight screenX screenY screenLeft screenTop openDatabase",
    "BarProp.prototype": "visible",
    "console": "memory",
    "Performance.prototype": "memory",
    "PerformanceTiming.prototype": "navigationStart",
    "Document.prototype": "interestCohort",
    "CookieStore.prototype": "get getAll set",
    "Navigator.prototype": "appName appCodeName appVersion mimeTypes cookieEnabled language languages userAgent "
    "plugins platform doNotTrack hardwareConcurrency maxTouchPoints mediaCapabilities mediaDevices deviceMemory "
    "connection onLine keyboard permissions presentation product productSub storage vendor vendorSub webdriver "
    "webkitPersistentStorage webkitTemporaryStorage getBattery getGamepads javaEnabled requestMediaKeySystemAccess",
    "NavigatorUAData.prototype": "brands platform getHighEntropyValues",
    "MediaDevices.prototype": "enumerateDevices",
    "Screen.prototype": "width height availWidth availHeight colorDepth pixelDepth availLeft availTop orientation",
    "HTMLCanvasElement.prototype": "constructor toDataURL toBlob",
    "CanvasRenderingContext2D.prototype": "measureText getImageData isPointInPath",
    "HTMLMediaElement.prototype": "canPlayType",
    "Date.prototype": "getTime getTimezoneOffset",
    "WebGLRenderingContext.prototype": "getSupportedExtensions getExtension getParameter getShaderPrecisionFormat "
    "getContextAttributes readPixels",
    "WebGL2RenderingContext.prototype": "getSupportedExtensions getExtension getParameter getShaderPrecisionFormat "
    "getContextAttributes readPixels",
    "OfflineAudioContext.prototype": "constructor",
    "AudioBuffer.prototype": "getChannelData",
    "AudioWorkletNode.prototype": "constructor",
    "RTCPeerConnection.prototype": "constructor",
    "RTCPeerConnectionIceEvent.prototype": "candidate",
    "SharedWorker.prototype": "constructor",
    "BroadcastChannel.prototype": "constructor",
    "Intl.DateTimeFormat.prototype": "resolvedOptions",
    "TouchEvent.prototype": "constructor",
    "Event.prototype": "timeStamp",
    "KeyboardEvent.prototype": "code keyCode",
    "MediaSource": "isTypeSupported",
    "speechSynthesis.__proto__": "getVoices",
    "Touch.prototype": "force radiusX radiusY rotationAngle",
    "URL": "createObjectURL",
    "Element.prototype": "getClientRects",
    "WheelEvent.prototype": "deltaX deltaY deltaZ",
    "Sensor.prototype": "constructor start",
    "DeviceOrientationEvent.prototype": "alpha beta gamma absolute",
    "DeviceMotionEvent.prototype": "acceleration accelerationIncludingGravity rotationRate",
    "Animation.prototype": "currentTime startTime",
    "Notification": "permission",
    "Gyroscope.prototype": "x y z constructor",
}
# Descriptions that are not object.member.
NAMED_PROBES = (
    'window.matchMedia("prefers-color-scheme")',
    'window.matchMedia("prefers-reduced-motion")',
    'window.matchMedia("color-gamut")',
    'window.matchMedia("pointer")',
    "document.fonts.check",
    "Document.cookie getter",
    "Document.cookie setter",
    'CSSStyleDeclaration.setProperty("fontFamily",…)',
)
# Probes whose arguments are stored.
SAVES_ARGUMENTS = ("Document.cookie setter", "CookieStore.prototype.set")


def api_dictionary(spark: SparkSession) -> DataFrame:
    """Dimension table of probed APIs: ``description, saveArguments``."""
    names = [f"{obj}.{member}" for obj, members in PROBES.items() for member in members.split()]
    rows = [(d, d in SAVES_ARGUMENTS) for d in (*names, *NAMED_PROBES)]
    return spark.createDataFrame(rows, "description string, saveArguments boolean")


def known_api_calls(calls: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    """calls of probed APIs with their ``saveArguments`` flag. The built-in dictionary has a
    fixed size below 200 rows; a caller's own is joined without a hint."""
    if dictionary is None:
        dictionary = F.broadcast(api_dictionary(calls.sparkSession))
    return calls.join(dictionary, "description")


def resolve_script_url(frames: DataFrame, scripts: DataFrame) -> DataFrame:
    """script-id URLs per page target. ``frames(page, target, seq, pos, scriptId, …)``."""
    return frames.join(scripts.select("page", "target", "scriptId", "scriptUrl"), ["page", "target", "scriptId"], "left")


def paused_call_sources(frames: DataFrame, scripts: DataFrame, pages: DataFrame, unattributed: str = "null_path") -> DataFrame:
    """D15/F4 over frame rows: the source of each paused call, ``page, target, seq, source``.

    ``frames(page, target, seq, depth, pos, url, functionScriptId, scriptId)``: depth 0 is the call
    stack, higher depths its async parents. ``scripts(page, target, scriptId, scriptUrl)`` and
    ``pages(page, mainUrl)``. The first URL in stack order is a running minimum, so deep stacks
    are never collected.
    """
    ids = scripts.select("page", "target", "scriptId", "scriptUrl")
    by_function = ids.withColumnsRenamed({"scriptId": "functionScriptId", "scriptUrl": "_functionUrl"})
    named = frames.join(by_function, ["page", "target", "functionScriptId"], "left")
    named = resolve_script_url(named, ids).join(pages.select("page", "mainUrl"), "page")
    place = lambda n, c: F.struct("depth", "pos", F.lit(n).alias("n"), F.col(c).alias("url"))
    options = named.select(
        "page", "target", "seq", "mainUrl", F.explode(F.array(place(0, "url"), place(1, "_functionUrl"), place(2, "scriptUrl"))).alias("o")
    )
    usable = F.col("o.url").rlike("(?i)^https?://") & (F.col("o.url") != F.col("mainUrl"))
    first = options.groupBy("page", "target", "seq", "mainUrl").agg(F.min(F.when(usable, F.col("o"))).alias("o"))
    found = F.when(F.col("o").isNotNull(), F.array("o.url"))
    return first.select("page", "target", "seq", frame_source(found, F.lit(None), F.col("mainUrl"), unattributed).alias("source"))


def attributed_calls(
    calls: DataFrame, url_filter: Callable[[Column, Column], Column] | None = None
) -> DataFrame:
    """Known calls with a storable source."""
    kept = known_api_calls(calls.filter("source <> '' AND description <> ''")).filter(is_storable(F.col("source")))
    return kept.filter(url_filter(F.col("page"), F.col("source"))) if url_filter else kept


def call_stats(calls: DataFrame, url_filter: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """Calls per (page, source, description)."""
    return attributed_calls(calls, url_filter).groupBy("page", "source", "description").agg(F.count("*").alias("calls"))


def nest_call_stats(stats: DataFrame) -> DataFrame:
    """Per (page, source) map api -> count. A source has at most one entry per dictionary API."""
    return stats.groupBy("page", "source").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("description", "calls")))).alias("stats")
    )


def saved_calls(calls: DataFrame, url_filter: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """Calls whose arguments are kept; ``seq`` is their order within the page."""
    kept = attributed_calls(calls, url_filter).filter("saveArguments")
    return kept.select("page", "seq", "source", "description", "arguments")

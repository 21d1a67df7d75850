"""Commands of the script language and their arguments.

Arguments: e expression, v variable, n number of one byte, s string up to a colon, z string up to a zero byte, o string
with swapped nibbles, F function; none where empty. A command of letters is its letters' bytes; with numbers before the arguments
it has a sub-command byte. The extended commands are 2f and their place in the list.
"""

from __future__ import annotations

from functools import lru_cache

# ---- fixed values

#: Commands of letters and their arguments.
LETTERS = {
    "CB": "eeeee", "CC": "eeeeee", "CD": "eeeeeeeeee", "CE": "eeeeeeeee", "CF": "eeeee", "CK": "neeeeeeee", "CL": "eeeee", "CM": "eeeeeeeee", "CP": "eee", "CS": "eeeeeee",
    "CT": "vee", "CU": "eeeeee", "CV": "eeeeee", "CX": "eeeeeeee", "CY": "eeeee", "CZ": "eeeeeee", "DC": "eee", "DF": "vee", "DI": "evv", "DR": "v", "DS": "vvee", "EC": "e",
    "EG": "evvvv", "EM": "evee", "EN": "veeee", "ES": "eeeeee", "F": "nee", "GS": "ev", "GX": "ee", "H": "ne", "IC": "ev", "IE": "ee", "IG": "veee", "IK": "n", "IM": "vv", "IX": "v",
    "IY": "e", "IZ": "ee", "KI": "vee", "KK": "e", "KN": "v", "KP": "v", "KQ": "ve", "KR": "v", "KW": "ve", "LC": "ees", "LD": "e", "LE": "nsee", "LHD": "ne", "LHG": "ne",
    "LHM": "ne", "LHS": "ne", "LHW": "ne", "LXC": "e", "LXG": "ess", "LXL": "eee", "LXO": "eee", "LXP": "eee", "LXR": "eve", "LXS": "evv", "LXW": "eve", "LXX": "eev", "LL": "neee",
    "LP": "eve", "LT": "ev", "MA": "ee", "MC": "ee", "MD": "eee", "ME": "eeeee", "MF": "veee", "MG": "ne", "MH": "eee", "MI": "ees", "MJ": "eeeee", "ML": "ve", "MM": "ee",
    "MN": "nev", "MP": "ee", "MS": "es", "MT": "s", "MV": "e", "MZ": "neee", "N+": "vee", "N-": "vee", "N*": "vee", "N/": "vee", "N>": "veev", "N<": "veev", "N=": "veev", "N\\": "ve",
    "N&": "vev", "N|": "vev", "N^": "vev", "N~": "ve", "NB": "vve", "NC": "ve", "NI": "veee", "NO": "nvve", "NP": "vvev", "NR": "ev", "NT": "s", "ND+": "eee", "ND-": "eee",
    "ND*": "eee", "ND/": "eee", "NDA": "ee", "NDC": "ee", "NDD": "ve", "NDH": "ee", "NDM": "ee", "PC": "e", "PD": "e", "PG": "vee", "PN": "e", "PP": "vee", "PS": "eeee", "QC": "ee",
    "QD": "e", "QE": "nsee", "QP": "eve", "SC": "v", "SI": "nv", "SL": "e", "SM": "e", "SO": "v", "SP": "ee", "SQ": "eee", "SS": "e", "ST": "e", "SU": "vv", "SV": "ee", "SW": "veee",
    "T": "ee", "UC": "ne", "UD": "e", "UG": "ee", "UR": "v", "US": "ee", "VA": "neee", "VB": "eeeeeee", "VC": "eeeeeee", "VE": "eeeeee", "VF": "", "VG": "eeee", "VH": "eeeeee",
    "VIC": "eeee", "VIP": "eeee", "VJ": "eeee", "VP": "eeeeee", "VR": "eev", "VS": "eeeee", "VT": "eeeeeeeeee", "VV": "ee", "VW": "eev", "VX": "eeee", "VZ": "nee", "WV": "eeee",
    "WW": "eee", "WX": "eeee", "WZ": "ne", "X": "e", "Y": "ee", "ZA": "ne", "ZB": "e", "ZC": "ee", "ZD": "ne", "ZE": "e", "ZF": "e", "ZG": "v", "ZH": "e", "ZI": "ee", "ZK": "ees",
    "ZL": "e", "ZM": "e", "ZR": "ev", "ZS": "e", "ZW": "e", "ZZ": "ne",
}

#: Commands whose arguments depend on a sub-command number.
NUMBERED = {
    "B": {0: "e", 1: "eeeeee", 2: "eeeeee", 3: "eeeeee", 4: "eeeeee", 10: "vv", 11: "vv", 12: "v", 13: "v", 14: "v", 21: "evv", 22: "evv", 23: "evv", 24: "evv", 31: "evv", 32: "evv", 33: "evv", 34: "evv"},
    "J": {0: "ee", 1: "ee", 2: "ee", 3: "ee", 4: ""},
    "PF": {0: "e", 1: "e", 2: "ee", 3: "ee"},
    "PW": {0: "e", 1: "e", 2: "ee", 3: "ee"},
    "PT": {0: "vee", 1: "vvvee", 2: "vvee"},
    "SG": {0: "e", 1: "e", 2: "e", 3: "e", 4: "e", 5: "ee", 6: "ee", 7: "ee", 8: "ee"},
    "SX": {1: "eee", 2: "v", 4: "v"},
    "UP": {0: "ee", 1: "se", 2: "ss", 3: "ss"},
    "ZT": {2: "v", 3: "v", 4: "v", 5: "v", 0: "e", 1: "e", 20: "e", 21: "e", 10: "eee", 11: "ev"},
    "newUP": {0: "ee", 1: "ze", 2: "zz", 3: "zz"},
}

#: The extended commands, in their places' order.
EXTENDED = {
    "TOC": "", "TOS": "", "TPC": "e", "TPS": "e", "TOP": "", "TPP": "", "inc": "v", "dec": "v", "TAA": "e", "TAB": "v", "wavLoad": "ee", "wavPlay": "ee", "wavStop": "e",
    "wavUnload": "e", "wavIsPlay": "ev", "wavFade": "eeee", "wavIsFade": "ev", "wavStopFade": "e", "trace": "z", "wav3DSetPos": "eeee", "wav3DCommit": "", "wav3DGetPos": "evvv",
    "wav3DSetPosL": "eee", "wav3DGetPosL": "vvv", "wav3DFadePos": "eeeee", "wav3DIsFadePos": "ev", "wav3DStopFadePos": "e", "wav3DFadePosL": "eeee", "wav3DIsFadePosL": "v",
    "wav3DStopFadePosL": "", "sndPlay": "ee", "sndStop": "", "sndIsPlay": "v", "msg": "z", "newHH": "ne", "newLC": "eez", "newLE": "nzee", "newLXG": "ezz", "newMI": "eez",
    "newMS": "ez", "newMT": "z", "newNT": "z", "newQE": "nzee", "newUP": "*", "newF": "nee", "wavWaitTime": "ee", "wavGetPlayPos": "ev", "wavWaitEnd": "e", "wavGetWaveTime": "ev",
    "menuSetCbkSelect": "F", "menuSetCbkCancel": "F", "menuClearCbkSelect": "", "menuClearCbkCancel": "", "wav3DSetMode": "ee", "grCopyStretch": "eeeeeeeee", "grFilterRect": "eeeee",
    "iptClearWheelCount": "", "iptGetWheelCount": "vv", "menuGetFontSize": "v", "msgGetFontSize": "v", "strGetCharType": "eev", "strGetLengthASCII": "ev", "sysWinMsgLock": "",
    "sysWinMsgUnlock": "", "aryCmpCount": "veev", "aryCmpTrans": "veeeev", "grBlendColorRect": "eeeeeeeee", "grDrawFillCircle": "eeee", "MHH": "eee", "menuSetCbkInit": "F",
    "menuClearCbkInit": "", "menu": "", "sysOpenShell": "z", "sysAddWebMenu": "zz", "iptSetMoveCursorTime": "e", "iptGetMoveCursorTime": "v", "grBlt": "eeeeee", "LXWT": "ez",
    "LXWS": "ee", "LXWE": "ee", "LXWH": "ene", "LXWHH": "ene", "sysGetOSName": "e", "patchEC": "e", "mathSetClipWindow": "eeee", "mathClip": "vvvvvv", "LXF": "ezz",
    "strInputDlg": "zeev", "strCheckASCII": "ev", "strCheckSJIS": "ev", "strMessageBox": "z", "strMessageBoxStr": "e", "grCopyUseAMapUseA": "eeeeeee", "grSetCEParam": "ee",
    "grEffectMoveView": "eeee", "cgSetCacheSize": "e", "dllCall": "", "gaijiSet": "ee", "gaijiClearAll": "", "menuGetLatestSelect": "v", "lnkIsLink": "eev", "lnkIsData": "eev",
    "fncSetTable": "eF", "fncSetTableFromStr": "eev", "fncClearTable": "e", "fncCall": "e", "fncSetReturnCode": "e", "fncGetReturnCode": "v", "msgSetOutputFlag": "e",
    "saveDeleteFile": "ev", "wav3DSetUseFlag": "e", "wavFadeVolume": "eeee", "patchEMEN": "e", "wmenuEnableMsgSkip": "e", "winGetFlipFlag": "v", "cdGetMaxTrack": "v",
    "dlgErrorOkCancel": "zv", "menuReduce": "e", "menuGetNumof": "v", "menuGetText": "ee", "menuGoto": "ee", "menuReturnGoto": "ee", "menuFreeShelterDIB": "", "msgFreeShelterDIB": "",
    "ainMsg": "", "ainH": "ne", "ainHH": "ne", "ainX": "e", "dataSetPointer": "F", "dataGetWORD": "ve", "dataGetString": "ee", "dataSkipWORD": "e", "dataSkipString": "e",
    "varGetNumof": "v", "patchG0": "e", "regReadString": "eeev", "fileCheckExist": "ev", "timeCheckCurDate": "eeev", "dlgManualProtect": "oo", "fileCheckDVD": "oeeov", "sysReset": "",
}

#: Extended commands that stand for one of letters from version 3.8 on, beside those named new and its letters.
SAME_NAME = ("TOC", "TOS", "TPC", "TPS", "TOP", "TPP", "MHH", "LXWT", "LXWS", "LXWE", "LXWH", "LXWHH", "LXF")
#: In every version.
ALWAYS = ("TAA", "TAB")
#: With messages in the side file.
WITH_MESSAGES = {"HH": "ainHH", "H": "ainH", "X": "ainX"}
OPERATORS = {"*": "77", "/": "78", "%": "c002", "+": "79", "-": "7a", "&": "74", "|": "75", "^": "76", "<": "7c", ">": "7d", "<=": "c003", ">=": "c004", "=": "7b", "\\": "7e", "$": ""}
LEVELS = (("*", "/", "%"), ("+", "-"), ("&", "|", "^"), ("<=", ">=", "<", ">"), ("=", "\\", "$"))
END, INDEX = 0x7F, b"\xc0\x01"


def letters() -> dict[str, str]:
    return LETTERS


def numbered() -> dict[str, dict[int, str]]:
    return NUMBERED


@lru_cache(maxsize=1)
def extended() -> dict[str, tuple[bytes, str]]:
    return {name: (bytes((0x2F, i)), arguments) for i, (name, arguments) in enumerate(EXTENDED.items())}
